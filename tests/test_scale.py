"""Plans and tasks that must not grow with a few common keys; rows of their own."""

import datetime as dt
import random
import re
import uuid
from collections import Counter

import duckdb
from oracle import rows_of
from pyspark.sql import functions as F

from tidemark.operators import graphs, history, ordered
from tidemark.plans import REGISTRY, run
from tidemark.session import shared_dir
from tidemark.streaming import stateful, streams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def test_no_sketch_per_order(spark):
    folder = place(spark, "tables")
    line = spark.range(5000).select((F.col("id") % 1700).alias("l_orderkey"), F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
                                    (F.col("id") * 7919 % 5003).cast("double").alias("l_extendedprice"))
    line.write.parquet(f"{folder}/lineitem.parquet")
    out = run("approximate_aggregates", spark, folder)
    assert rows(out) == [("A", True, True), ("N", True, True)]
    plan = plan_of(out)
    assert not re.search(r"ObjectHashAggregate\(keys=\[[^\]]*l_orderkey", plan)
    assert "SortMergeJoin" not in plan


def test_ids_seen_once_are_kept_in_buckets(spark):
    base, r, seen = place(spark, "once"), random.Random(3), []
    for n in range(3):
        drop = [(f"id {r.randrange(4000)}" if k % 50 else None, n * 10_000 + k) for k in range(3000)]
        seen += drop
        df = spark.createDataFrame(drop, "id string, v long")
        df.write.parquet(f"{base}/land/drop={n}")
        stream = streams.stream_files(spark, f"{base}/land", df.schema)
        q = streams.run_to_log(stateful.once_changes(stream, "id"), f"{base}/out", f"{base}/state", "append")
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 1024
        often = Counter(k for k, _ in seen)
        assert rows(stateful.settled(spark, f"{base}/out", ["id"])) == sorted(((k, v) for k, v in seen if k and often[k] == 1), key=repr)
    # a change is told once: set when first seen, unset when seen again, nothing after that
    told = Counter(tuple(x) for x in spark.read.parquet(f"{base}/out").select("id", "op").collect())
    assert set(told.values()) == {1}


def test_pairs_of_a_segment_are_spread_and_distinct(spark):
    accounts = spark.range(2000).select((F.col("id") % 1500).alias("a"), F.lit("only").alias("s"), F.when(F.col("id") % 9 == 0, 3).alias("o"))
    users = spark.createDataFrame([(k, None, True) for k in range(30)], "u long, m long, active boolean")
    segments = spark.createDataFrame([(k % 30, "only", "segment") for k in range(60)], "u long, s string, b string")
    out = graphs.account_entitlements(accounts, users, segments, "a", ["o"], "s", "u", "m", "active", "b")
    geo = out.where("entitlement_basis = 'geo_segment'")
    assert rows(geo.select("a", "u")) == sorted(((a, u) for a in range(1500) for u in range(30) if u != 3), key=repr)
    sizes = [len(x) for x in geo.select("a").rdd.glom().collect()]
    assert max(sizes) < 0.6 * sum(sizes)
    assert not re.search(r"hashpartitioning\([^)]*entitlement_basis", plan_of(out))


def test_quantiles_never_gather_a_key(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), (F.col("id") * 31 % 6007).cast("double").alias("x"))
    want = rows(df.groupBy("k").agg(F.percentile("x", F.lit(0.5)), F.percentile("x", F.lit(0.9))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ordered.quantiles(df, ["k"], "x", {"a": 0.5, "b": 0.9}, most=500, cells=64)
        assert rows(out) == want
        assert "SortMergeJoin" not in plan_of(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def lines_and_orders(spark, n=400):
    folder, day = place(spark, "tables"), lambda x: F.date_add(F.lit("1995-01-01").cast("date"), x.cast("int")).cast("timestamp_ntz")
    k = F.col("id")
    spark.range(n).select(k.alias("o_orderkey"), (k % 40).alias("o_custkey"), day(k * 7 % 900).alias("o_orderdate"), F.concat(F.lit("p"), k % 5).alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    spark.range(4 * n).select((k % n).alias("l_orderkey"), (k % 11).alias("l_suppkey"), day(k % n * 7 % 900 + k % 100).alias("l_shipdate"), (k % 97).cast("double").alias("l_extendedprice"),
                              (k % 3).cast("string").alias("l_returnflag"), k.alias("l_partkey"), k.cast("double").alias("l_quantity")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(11).select(k.alias("s_suppkey"), (k % 4).alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    return folder


def same_as_sql(df, folder):
    con = duckdb.connect()
    for t in ("orders", "lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder.removeprefix('file://').removeprefix('file:')}/{t}.parquet/*.parquet'")
    return lambda name: spark_and_sql(df, con.execute(REGISTRY[name].sql))


def spark_and_sql(df, found):
    return rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in found.description], found.fetchall())


def test_merged_histories_stay_apart(spark):
    folder = lines_and_orders(spark)
    out = run("merge_histories", spark, folder)
    assert same_as_sql(out, folder)("merge_histories")
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_items_stay_apart(spark):
    folder = lines_and_orders(spark)
    out = run("collaboration_count", spark, folder)
    assert same_as_sql(out, folder)("collaboration_count")
    assert "REPARTITION_BY_NUM" in plan_of(out)


def test_months_of_charges_never_travel(spark):
    folder = lines_and_orders(spark)
    out = run("expand_charges_monthly", spark, folder)
    assert same_as_sql(out, folder)("expand_charges_monthly")
    assert not re.search(r"hashpartitioning\(account_id[^)]*period", plan_of(out))
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_labels_and_entities_meet_in_years(spark):
    day = lambda n: dt.date(1999, 11, 1) + dt.timedelta(days=n)
    r = random.Random(5)
    labels = [(k, f"s{k}{j}", day(60 * j + k), day(60 * j + k + 35 + 25 * (j % 2)) if j < 7 else None) for k in range(4) for j in range(8)]
    entities = [(n, n % 5, day(a := r.randrange(-20, 420)), day(a + r.randrange(-3, 90)) if n % 6 else None) for n in range(90)]
    horizon = day(500)
    e, lab = spark.createDataFrame(entities, "id int, k int, a date, b date"), spark.createDataFrame(labels, "k int, v string, f date, u date")
    out = history.state_intervals(e, lab, "k", "a", "b", horizon, "v", "f", "u")
    end, want = horizon + dt.timedelta(days=1), Counter()
    for n, k, a, b in entities:
        for x in range((max((b or end), a) - a).days):
            at = a + dt.timedelta(days=x)
            want[n, next((v for j, v, f, u in labels if j == k and f <= at < (u or end)), None), at] += 1
    got, cuts = Counter(), 0
    for x in out.collect():
        assert x.open_from < x.open_to and (x.open_from.year, x.open_from.month) == ((x.open_to - dt.timedelta(days=1)).year, (x.open_to - dt.timedelta(days=1)).month)
        got.update((x.id, x.v, x.open_from + dt.timedelta(days=d)) for d in range((x.open_to - x.open_from).days))
        cuts += 1
    assert got == want and cuts > len(entities)
    assert not re.search(r"hashpartitioning\([^)]*__bin", plan_of(out))
