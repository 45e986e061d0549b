"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import run  # noqa: E402
from tidemark.plans.q_streams import CSV_COLUMNS  # noqa: E402
from tidemark.session import get_spark, shared_dir  # noqa: E402
from tidemark.sources import files  # noqa: E402

HEADLINE = [
    "movement_monthly", "retention_yearly", "expand_charges_monthly", "collapse_plan_history", "order_with_valid_plan",
    "purchase_last_view", "sessions_by_gap", "page_views", "active_users_monthly", "attribution", "to_date_totals",
    "overlap_attribution", "allocation_ratio", "mapping_by_priority", "balance_rollforward", "cumulative_balance_fx", "order_chains",
    "flatten_hierarchy", "price_quantiles", "percent_rank_threshold", "breakout", "check_constraints", "document_words",
    "unpack_contexts", "flatten_metrics", "run_stats", "csv_update", "date_dimension",
]
# The widest plans and longest loops, run once after their warm-up.
HEAVY = ["critical_path", "order_state_on_day", "scorecard", "merge_histories", "available_to_renew"]


def csv_million(spark, folder: str) -> float:
    """Seconds to rewrite a CSV file of 1,000,000 rows (limit: 300), its writing not counted."""
    path = f"{shared_dir(spark)}/csv-million-{os.getpid()}"
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    rows = items.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(-(-1_000_000 // items.count()))))).limit(1_000_000)
    rows.select(F.monotonically_increasing_id().alias("id"), F.col("l_returnflag").alias("name"), F.col("l_extendedprice").cast("decimal(12,2)").alias("purchase_amount"),
                F.to_date("l_shipdate").alias("purchase_date")).write.csv(f"{path}/in", header=True)
    start = time.perf_counter()
    files.csv_update(spark, f"{path}/in", f"{path}/out", CSV_COLUMNS, "id", "purchase_amount", lambda x: x + 10)
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or [*HEADLINE, *HEAVY]
    spark = get_spark("bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        runs = []
        run(name, spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
        for _ in range(1 if name in HEAVY else repeats):
            start = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        times["csv_update_1m"] = round(csv_million(spark, folder), 3)
    print(json.dumps({"metric": "sum of per-query medians", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
