"""Properties and edge cases the tables do not show."""

import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.functions import scalars as s
from tidemark.operators import calendar, finance, graphs, history, keys, ordered, paths, planning, quality, revenue, semistructured, service, text_rules, usage
from tidemark.plans import run
from tidemark.sources import files

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows; values repeat and some are NULL."""
    rnd = random.Random(7)
    data = []
    for n in range(6000):
        key = 0 if n % 3 else rnd.randint(1, 40)
        data.append((n, key, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20)),
                     None if n % 11 == 0 else float(rnd.choice([1, 2, 2, 2, 50, 1000, 10 ** 6]) + rnd.randint(0, 30))))
    con = duckdb.connect()
    con.register("d", pa.table(dict(zip(["id", "k", "ts", "x"], map(list, zip(*data))))))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("x", T.DoubleType())])
    return spark.createDataFrame(data, schema), con


def test_blocked_windows_equal_plain_windows(skewed):
    df, con = skewed
    day = F.to_date("ts")
    out = ordered.with_previous(df, ["k"], ["ts", "id"], day, {"px": "x", "pid": "id"})
    out = ordered.with_next(out, ["k"], ["ts", "id"], day, {"nx": "x", "nid": "id"})
    out = ordered.with_running_sum(out, ["k"], ["ts", "id"], day, {"n": F.lit(1).cast("long"), "sx": "x"})
    out = ordered.with_last_known(out, ["k"], ["ts", "id"], day, {"lx": "x"})
    out = ordered.with_next_known(out, ["k"], ["ts", "id"], day, {"fx": "x"})
    want = con.execute("""SELECT id, lag(x) OVER w, lag(id) OVER w, lead(x) OVER w, lead(id) OVER w, row_number() OVER w, sum(x) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING),
      last_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING), first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      FROM d WINDOW w AS (PARTITION BY k ORDER BY ts, id)""").fetchall()
    assert rows(out.select("id", "px", "pid", "nx", "nid", "n", "sx", "lx", "fx")) == sorted(want, key=repr)


@pytest.mark.parametrize("parts", [1, 8, 40, 400])
def test_keys_cut_by_volume_equal_plain_windows(skewed, parts):
    df, con = skewed
    split = ordered.cut(df, ["k"], ["ts", "id"], parts=parts)
    out = ordered.with_previous(df, ["k"], ["ts", "id"], split, {"px": "x", "pid": "id"})
    out = ordered.with_next(out, ["k"], ["ts", "id"], split, {"nx": "x", "nid": "id"})
    out = ordered.with_running_sum(out, ["k"], ["ts", "id"], split, {"n": F.lit(1).cast("long"), "sx": "x"})
    out = ordered.with_last_known(out, ["k"], ["ts", "id"], split, {"lx": "x"})
    out = ordered.with_next_known(out, ["k"], ["ts", "id"], split, {"fx": "x"})
    want = con.execute("""SELECT id, lag(x) OVER w, lag(id) OVER w, lead(x) OVER w, lead(id) OVER w, row_number() OVER w, sum(x) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING),
      last_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING), first_value(x IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      FROM d WINDOW w AS (PARTITION BY k ORDER BY ts, id)""").fetchall()
    assert rows(out.select("id", "px", "pid", "nx", "nid", "n", "sx", "lx", "fx")) == sorted(want, key=repr)
    ahead = ordered.with_next_rows(df, ["k"], ["ts", "id"], split, {"id": "id"}, 5, "ahead")
    want = con.execute("SELECT id, coalesce(list(id) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), []) FROM d").fetchall()
    assert rows(ahead.select("id", F.transform("ahead", lambda r: r["id"]).alias("a"))) == sorted(want, key=repr)


def test_user_of_one_day_is_spread_and_read_once(spark):
    """A user with 90 % of a day's events: every range holds about its share, and rows and summaries read one exchange."""
    n, parts = 40_000, 16
    df = spark.range(n).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id") % 997).alias("u"), F.col("id"),
        (F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 7919 % n) * 2)).alias("ts"))
    split = ordered.cut(df, ["u"], ["ts", "id"], parts=parts, sample=16 * parts)
    base, hot = ordered._laid(df, ["u"], ["ts", "id"], split)
    sizes = [r["count"] for r in base.where(hot).groupBy(ordered.KEY, ordered.BLOCK).count().collect()]
    assert len(sizes) >= parts * 0.8 and max(sizes) < 2.5 * n / parts
    out = ordered.with_islands(df, ["u"], ["ts", "id"], split, {"ts": "ts"}, lambda p: F.timestamp_diff("SECOND", p["ts"], F.col("ts")) > 2, "s")
    w = W.partitionBy("u").orderBy("ts", "id")
    gap = F.timestamp_diff("SECOND", F.lag("ts").over(w), F.col("ts"))
    plain = df.withColumn("o", F.coalesce((gap > 2).cast("int"), F.lit(1))).withColumn("s", F.sum("o").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("o")
    assert out.exceptAll(plain).count() == 0 and out.count() == n
    out.write.format("noop").mode("overwrite").save()


def scans(df):
    plan = df._jdf.queryExecution().explainString(spark_mode(df))
    return plan.split("== Physical Plan ==")[1].count("FileScan")


def spark_mode(df):
    return df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")


@pytest.mark.parametrize("name, most", [("sessions_by_gap", 1), ("merge_histories", 3), ("collapse_plan_history", 1)])
def test_ordered_queries_scan_their_input_once(spark, name, most):
    assert scans(run(name, spark, FOLDER)) <= most


@pytest.mark.parametrize("cells, most", [(8, 20), (16, 1), (4, 500), (1024, 10)])
def test_quantiles_by_narrowing(skewed, cells, most):
    df, con = skewed
    probs = {"a": 0.0, "b": 0.013, "m": 0.5, "n": 0.501, "c": 0.9, "z": 1.0}
    want = con.execute("SELECT k, " + ", ".join(f"quantile_cont(x, {p})" for p in probs.values()) + " FROM d WHERE x IS NOT NULL GROUP BY k").fetchall()
    got = rows(ordered.quantiles(df, ["k"], "x", probs, most=most, cells=cells))
    assert [[round(v, 6) for v in r] for r in got] == [[round(v, 6) for v in r] for r in sorted(want, key=repr)]


def test_last_round_of_quantiles_reads_few_rows(spark):
    """Far apart values, half of them equal: what is sorted doesn't grow with the table."""
    big = spark.range(200_000).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.pow(F.lit(1.0001), F.col("id"))).alias("x"))
    probs = {"q1": 0.2, "q2": 0.77, "q3": 0.999}
    got = ordered.quantiles(big, ["k"], "x", probs, most=2000, cells=64).first()
    want = big.agg(*[F.percentile("x", F.lit(p)) for p in probs.values()]).first()
    assert [got[n] for n in probs] == pytest.approx(list(want))


def test_next_rows_cross_blocks(skewed):
    df, con = skewed
    for unit in ("hour", "day", "year"):
        out = ordered.with_next_rows(df, ["k"], ["ts", "id"], F.date_trunc(unit, "ts"), {"id": "id"}, 5, "ahead")
        got = out.select("id", F.transform("ahead", lambda r: r["id"]).alias("a"))
        want = con.execute("SELECT id, coalesce(list(id) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), []) FROM d").fetchall()
        assert rows(got) == sorted(want, key=repr)


def test_quantiles_and_ranks(skewed):
    df, con = skewed
    q = ordered.quantiles(df, ["k"], "x", {"a": 0.0, "b": 0.25, "m": 0.5, "c": 0.9, "z": 1.0})
    want = con.execute("SELECT k, quantile_cont(x, 0.0), quantile_cont(x, 0.25), median(x), quantile_cont(x, 0.9), max(x) FROM d WHERE x IS NOT NULL GROUP BY 1").fetchall()
    got = {r[0]: tuple(r)[1:] for r in q.collect()}
    assert len(got) == len(want)
    for k, *v in want:
        assert got[k] == pytest.approx(v)
    p = ordered.with_percent_rank(df, ["k"], "x").where(F.col("x").isNotNull()).select("id", F.round("percent_rank", 9))
    want = con.execute("SELECT id, round(percent_rank() OVER (PARTITION BY k ORDER BY x), 9) FROM d WHERE x IS NOT NULL").fetchall()
    assert rows(p) == sorted(want, key=repr)


def test_islands_equal_plain_windows(skewed):
    df, con = skewed
    opens = lambda prev: (F.col("ts") - prev["ts"]) > F.expr("INTERVAL 25 MINUTES")
    out = ordered.with_islands(df, ["k"], ["ts", "id"], F.to_date("ts"), {"ts": "ts"}, opens, "island").select("id", "island")
    want = con.execute("""SELECT id, CAST(sum(o) OVER (PARTITION BY k ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS BIGINT) FROM (SELECT *,
      CASE WHEN coalesce(ts - lag(ts) OVER (PARTITION BY k ORDER BY ts, id) > INTERVAL 25 MINUTE, true) THEN 1 ELSE 0 END AS o FROM d)""").fetchall()
    assert rows(out) == sorted(want, key=repr)


def test_ranks_without_keys(skewed):
    df, con = skewed
    got = ordered.with_cumulative_count(df, [], "x").select("x", "__below", "__n", "__total")
    want = con.execute("SELECT x, CAST(sum(n) OVER (ORDER BY x) - n AS BIGINT), n, CAST(sum(n) OVER () AS BIGINT) FROM (SELECT x, count(*) AS n FROM d WHERE x IS NOT NULL GROUP BY 1)").fetchall()
    assert rows(got) == sorted(want, key=repr)


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 3.0)], "k int, x double")
    assert rows(ordered.quantiles(df, ["k"], "x", {"m": 0.5})) == [(1, 5.0), (2, 3.0)]


def test_asof_has_gap_and_boundary(spark):
    dim = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (1, "b", dt.date(2024, 1, 20), None)], "k int, v string, f date, u date")
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 3, 1)]
    fact = spark.createDataFrame([(1, d) for d in days] + [(2, days[1])], "k int, d date")
    got = {(r.k, r.d): r.v for r in history.asof_scd(fact, dim, "k", "d", ["v"], "f", "u").collect()}
    assert [got[(1, d)] for d in days] == [None, "a", "a", None, "b", "b"] and got[(2, days[1])] is None


def test_collapse_keeps_gaps_and_returns(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([(1, "a", d(1), d(3)), (1, "a", d(3), d(5)), (1, "a", d(7), d(8)), (1, "b", d(8), d(9)), (1, "a", d(9), None)], "k int, v string, f date, u date")
    got = history.collapse_scd(df, ["k"], ["v"], "f", "u", F.col("f")).orderBy("f").collect()
    assert [(r.v, r.f, r.u) for r in got] == [("a", d(1), d(5)), ("a", d(7), d(8)), ("b", d(8), d(9)), ("a", d(9), None)]


def test_scd_intervals_are_disjoint(spark):
    df = run("collapse_plan_history", spark, FOLDER)
    prev = ordered.with_previous(df, ["key"], ["valid_from"], F.lit(0), {"p": "valid_to"})
    assert prev.where(F.col("p") > F.col("valid_from")).count() == 0


def test_chain_edges(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 6), (6, 5), (7, 99), (8, 8)], "id long, target long")
    assert rows(graphs.resolve_redirects(df, "id", "target")) == [(1, 1, False, 0), (2, 1, True, 1), (3, 1, True, 2), (4, 1, True, 3)]


def test_long_chain_takes_few_rounds(spark):
    n = 3000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p"))
    out = graphs.resolve_chains(df, "id", "p")
    assert out.agg(F.max("steps"), F.countDistinct("root"), F.count("*")).first() == (n - 1, 1, n)


def test_hierarchy_has_no_depth_limit(spark):
    chain = [(k, k - 1 or None, f"n{k}") for k in range(1, 14)]
    df = spark.createDataFrame([*chain, (50, 99, "orphan"), (60, 61, "circle"), (61, 60, "circle")], "id long, parent long, name string")
    got = {r.id: r for r in graphs.flatten_hierarchy(df, "id", "parent", "name", 3).collect()}
    assert sorted(got) == list(range(1, 14))
    assert (got[3].lvl_1_name, got[3].lvl_2_name, got[3].lvl_3_name, got[3].deeper) == ("n1", "n2", "n3", [])
    assert got[13].hierarchy_level == 13 and [d.id for d in got[13].deeper] == list(range(4, 14))


def test_nested_payload_has_no_depth_limit(spark):
    text = '{"a":' * 12 + "[7]" + "}" * 12
    got = semistructured.flatten_metrics(spark.createDataFrame([(1, text), (2, None), (3, "{}")], "id int, payload string"), "id", "payload").collect()
    assert [(r.path, r.value) for r in got if r.id == 1] == [(".".join("a" * 12) + "[0]", "7")]


def test_long_lineage_and_cycles(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    df = spark.createDataFrame([(k, k - 1 or None, d(0), d(9)) for k in range(1, 71)], "id int, parent int, f date, u date")
    assert graphs.temporal_lineage(df, "id", "parent", "f", "u").agg(F.max("depth")).first()[0] == 70
    nodes = spark.createDataFrame([(1, x, 1.0) for x in "abcd"], "run int, node string, cost double")
    edges = spark.createDataFrame([(1, "a", "b"), (1, "b", "c"), (1, "c", "b"), (1, "c", "d")], "run int, parent string, child string")
    with pytest.raises(ValueError, match="cycle"):
        graphs.critical_path(nodes, edges, "run", "node", "cost")


def test_hash_keeps_parts_apart(spark):
    now = spark.createDataFrame([(1, "x|y", "z"), (2, "~", "a"), (3, "1:a", None)], "id int, a string, b string")
    old = spark.createDataFrame([(1, "x", "y|z"), (2, None, "a"), (3, "1:a", None)], "id int, a string, b string").withColumn("last_changed", F.lit(dt.date(2020, 1, 1)))
    got = {r.id: r.status for r in keys.hash_diff(now, old, "id", ["a", "b"], dt.date(2024, 1, 1)).collect()}
    assert got == {1: "changed", 2: "changed", 3: "unchanged"}


def test_null_keys_are_a_key(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 2, 4.0), (1, 1, 8.0)], "k int, t int, x double")
    part = F.lit(0)
    got = {(r.k, r.t): (r.s, r.p) for r in ordered.with_previous(ordered.with_running_sum(df, ["k"], ["t"], part, {"s": "x"}), ["k"], ["t"], part, {"p": "x"}).collect()}
    assert got == {(None, 1): (2.0, None), (None, 2): (6.0, 2.0), (1, 1): (8.0, None)}
    assert {r.k: r.total for r in ordered.with_totals(df, ["k"], {"total": F.sum("x")}).collect()} == {None: 6.0, 1: 8.0}
    facts = spark.createDataFrame([("b1", None, 100.0)], "brand string, kind string, cost double")
    rules = spark.createDataFrame([("b1", None, 0.5, "half")], "brand string, kind string, pct double, label string")
    out = finance.apply_mapping_by_priority(facts, rules, [["brand", "kind"], ["brand"]], ["brand", "kind"], "pct", ["cost"], ["label"]).collect()
    assert [(r.label, r.cost) for r in out] == [("half", 50.0)]


def test_outlier_leaves_ranges_even(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, 1e15).otherwise(F.col("id").cast("double")).alias("x"))
    base, hot = ordered._laid(df, ["k"], ["x"], ordered.cut(df, ["k"], ["x"], parts=64, sample=16 * 64))
    depth = base.where(hot).groupBy(ordered.BLOCK).count().agg(F.max("count"), F.count("*")).first()
    assert depth[0] < 4 * 20000 / 64 and depth[1] > 48


def test_cycles_and_lost_ends_have_no_root(spark):
    pairs = [(1, None), (2, 1), (3, 99), (5, 6), (6, 5), (7, 6), (8, 8), *((k, k - 1) for k in range(101, 140)), (100, 1)]
    got = {r.id: (r.root, r.steps) for r in graphs.resolve_chains(spark.createDataFrame(pairs, "id long, up long"), "id", "up").collect()}
    assert got == {1: (1, 0), 2: (1, 1), 100: (1, 1)} | {k: (1, k - 99) for k in range(101, 140)}


def test_open_per_day_equals_counting_days(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rnd = random.Random(3)
    data = [(k, rnd.choice(["a", "b", None]), d(rnd.randrange(30)), rnd.choice([None, d(rnd.randrange(40))])) for k in range(200)]
    df = spark.createDataFrame(data, "id int, g string, f date, u date")
    days = calendar.expand_interval(df, "f", "u", "day", d(35), "day").groupBy("g", "day").agg(F.count("*").alias("n"), F.sum(F.datediff("day", "f")).alias("age"))
    assert rows(calendar.open_per_day(df, ["g"], "f", "u", d(35)).select("g", "day", "open_count", "total_age")) == rows(days.select("g", "day", "n", "age"))
    pieces = calendar.expand_interval(planning.ramp_intervals(df, "f", "u", 5).where("ramp_from < coalesce(ramp_to, date'2030-01-01')"), "ramp_from", "ramp_to", "day", d(35), "day")
    assert rows(pieces.select("id", "day", "ramp_status")) == rows(planning.ramp_status(df, "f", "u", d(35), 5).select("id", "day", "ramp_status"))


def test_points_on_a_threshold(spark):
    df = spark.createDataFrame([(0.5,), (0.8,), (0.79,)], "x double")
    got = [tuple(r) for r in df.select(usage.points(F.col("x"), 0.5, 0.8, True), usage.points(F.col("x"), 0.5, 0.8)).collect()]
    assert got == [(63, 25), (88, 63), (63, 63)]


def test_critical_path(spark):
    nodes = spark.createDataFrame([(1, "a", 5.0), (1, "b", 1.0), (1, "c", 9.0), (1, "d", 100.0), (2, "x", 3.0), (3, "p", 1.0), (3, "q", 2.0)], "run int, node string, cost double")
    edges = spark.createDataFrame([(1, "a", "b"), (1, "a", "c"), (1, "b", "d"), (1, "c", "d"), (1, "gone", "a"), (3, "p", "q")], "run int, parent string, child string")
    got = {r.run: (r.path_length, r.critical_path) for r in graphs.critical_path(nodes, edges, "run", "node", "cost").collect()}
    # the last node's cost is not counted; a run without edges has paths of one node and length 0
    assert got == {1: (14.0, ["a", "c", "d"]), 2: (0.0, ["x"]), 3: (1.0, ["p", "q"])}


def test_temporal_lineage_needs_overlap(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([(1, None, d(1), d(20)), (2, 1, d(5), d(30)), (3, 2, d(19), d(25)), (4, 2, d(21), d(25))], "id int, parent int, f date, u date")
    got = {r.id: (r.path, r.valid_from, r.valid_to) for r in graphs.temporal_lineage(df, "id", "parent", "f", "u").collect()}
    assert got == {1: ([1], d(1), d(20)), 2: ([1, 2], d(5), d(20)), 3: ([1, 2, 3], d(19), d(20))}


def test_retention_never_exceeds_either_side(spark):
    r = run("retention_yearly", spark, FOLDER)
    assert r.where((F.col("gross_retention") > F.col("net_retention")) | (F.col("gross_retention") > F.col("prior_amount"))).count() == 0


def test_movement_closes(spark):
    m = run("movement_monthly", spark, FOLDER)
    per = m.groupBy("account_id").agg(F.round(F.sum("delta"), 2).alias("d"))
    assert per.where(F.abs("d") > 0.01).count() == 0  # opening 0, closing 0 after the churn month
    assert m.where(F.col("change_type").isNull()).count() == 0


def test_attribution_sums_to_one(spark):
    a = run("attribution", spark, FOLDER).groupBy("conversion").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    assert a.where(F.abs(F.col("w") - 1) > 1e-6 * (F.col("n") + 1)).count() == 0


def test_allocation_sums_to_one(spark):
    a = run("allocation_ratio", spark, FOLDER).groupBy("day").agg(F.sum("share").alias("w"))
    assert a.where(F.abs(F.col("w") - 1) > 1e-4).count() == 0


def test_rollforward_opening_plus_movement_is_closing(spark):
    b = run("balance_rollforward", spark, FOLDER)
    gap = F.col("starting_balance") + F.col("billing") + F.col("payments") + F.col("refunds") + F.col("adjustments") - F.col("ending_balance")
    assert b.where(F.abs(gap) > 0.01).count() == 0


def test_overlap_equal_bounds_have_no_duration(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    iv = spark.createDataFrame([("w", 1, t0, t0 + dt.timedelta(hours=1)), ("w", 2, t0 + dt.timedelta(minutes=30), t0 + dt.timedelta(hours=3))], "k string, id int, start timestamp_ntz, end timestamp_ntz")
    m = spark.createDataFrame([("w", t0 + dt.timedelta(hours=h), t0 + dt.timedelta(hours=h + 1), 10.0) for h in range(3)], "k string, start timestamp_ntz, end timestamp_ntz, c double")
    got = {(r.id, r.meter_start.hour): (r.overlap_ms, r.attributed) for r in finance.overlap_attribution(iv, m, "k", "id", "c").collect()}
    assert got == {(1, 0): (None, None), (2, 0): (1800000, 10.0), (2, 1): (3600000, 10.0), (2, 2): (3600000, 10.0)}


def test_boundary_diff(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 30), dt.datetime(2024, 2, 1, 0, 30))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(*[s.boundary_diff(u, "a", "b") for u in ("year", "quarter", "month", "week", "day", "hour", "minute")]).first()
    assert tuple(got) == (0, 0, 1, 0, 1, 1, 60)


def test_business_days(spark):
    spine = calendar.date_spine(spark, dt.date(2023, 1, 1), dt.date(2025, 1, 1))
    dim = calendar.date_dimension(spine).where(F.col("business_day_of_quarter").isNotNull())
    seen = {}
    for r in dim.orderBy("date_day").select("fiscal_quarter_name", "business_day_of_quarter", "date_day", "first_day_of_fiscal_quarter").collect():
        if r.first_day_of_fiscal_quarter < dt.date(2023, 1, 1):
            continue
        seen[r[0]] = seen.get(r[0], 0) + 1
        assert r[1] == seen[r[0]], r


def test_expand_interval_open_and_empty(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 15), None), (2, dt.date(2024, 1, 15), dt.date(2024, 1, 15)), (3, dt.date(2024, 1, 15), dt.date(2024, 3, 1))], "id int, f date, u date")
    got = rows(calendar.expand_interval(df, "f", "u", "month", dt.date(2024, 4, 10)).select("id", F.month("period")))
    assert got == [(1, 1), (1, 2), (1, 3), (1, 4), (3, 1), (3, 2)]
    days = calendar.expand_interval(df, "f", "u", "day", dt.date(2024, 1, 17)).groupBy("id").count()
    assert {r.id: r["count"] for r in days.collect()} == {1: 3, 3: 46}


def test_sessionize_hot_user(spark):
    t0 = dt.datetime(2024, 1, 1)
    at = [0, 10, 40, 71, 60 * 24, 60 * 24 + 30, 60 * 24 * 3]
    df = spark.createDataFrame([(1, t0 + dt.timedelta(minutes=m), n) for n, m in enumerate(at)], "u int, ts timestamp_ntz, id int")
    got = [r.session_index for r in usage.sessionize(df, "u", "ts", "id", 30).orderBy("ts").collect()]
    assert got == [1, 1, 1, 2, 3, 3, 4]


def test_page_views_clip_and_engagement(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("p", "page_view", t0, 100, 200, 0, 0, "u"), ("p", "page_ping", t0 + dt.timedelta(seconds=30), 100, 200, 500, 60, "u"), ("q", "page_ping", t0, 0, 0, 1, 1, "v")],
                               "page string, kind string, ts timestamp_ntz, w int, h int, x int, y int, who string")
    got = usage.page_views(df, "page", "kind", "ts", "w", "h", "x", "y", ["who"]).collect()
    assert len(got) == 1  # a page without a view is no page view
    r = got[0]
    assert (r.time_engaged_in_s, r.scroll_x_max, r.horizontal_percentage_scrolled, r.vertical_percentage_scrolled, r.user_engaged) == (30, 100, 100.0, 30.0, True)


def test_mapping_prefers_specific_rule(spark):
    f = spark.createDataFrame([("a", "x", 100.0), ("a", "y", 100.0), ("b", "x", 100.0)], "p string, s string, cost double")
    m = spark.createDataFrame([("a", None, 1.0, "by p"), ("a", "x", 0.3, "team1"), ("a", "x", 0.7, "team2")], "p string, s string, pct double, label string")
    got = rows(finance.apply_mapping_by_priority(f, m, [["p", "s"], ["p"]], ["p", "s"], "pct", ["cost"], ["label"]))
    assert got == [("a", "x", "team1", 30.0), ("a", "x", "team2", 70.0), ("a", "y", "by p", 100.0), ("b", "x", None, 100.0)]


def test_constraints_where_and_severity(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    got = {r.constraint: (r.failures, r.status) for r in quality.check(df, [
        {"name": "nn", "kind": "not_null", "column": "id", "where": F.col("v") != "c"}, {"name": "u", "kind": "unique", "columns": ["id"], "severity": "warn"}]).collect()}
    assert got == {"nn": (0, "pass"), "u": (1, "warn")}


def test_dynamic_pivot_refuses_too_many(spark):
    with pytest.raises(ValueError):
        quality.dynamic_pivot(spark.range(10), [], "id", F.lit(1), 5)


def test_case_safe_id(spark):
    got = spark.range(1).select(s.case_safe_id(F.lit("0013000000AbCdE")), s.case_safe_id(F.lit("x"))).first()
    assert got[0] == "0013000000AbCdEAAV" and got[1] == "x"


def test_ip_number(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("256.1.1.1",), ("junk",), (None,)], "ip string")
    assert [r[0] for r in df.select(s.ip_number("ip")).collect()] == [16909060, None, None, None]


def test_histogram_mode(spark):
    df = spark.createDataFrame([(1, x) for x in (1.0, 1.1, 1.2, 1.1, 9.0)] + [(2, 4.0)], "k int, x double")
    got = {r.k: r.m for r in service.histogram_mode(df, ["k"], "x", "m").collect()}
    assert 1.0 < got[1] < 4.0 and got[2] == 4.0


def test_csv_order_is_kept(spark, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text("id,name,purchase_amount,purchase_date\n" + "".join(f"{n},n{n},{n}.5,2024-01-01\n" for n in range(1, 2001)))
    cols = {"id": "BIGINT", "name": "STRING", "purchase_amount": "DECIMAL(12,2)", "purchase_date": "DATE"}
    files.csv_update(spark, str(src), str(tmp_path / "out"), cols, "id", "purchase_amount", lambda x: x + 10)
    lines = [ln for p in sorted((tmp_path / "out").glob("part-*")) for ln in p.read_text().splitlines() if not ln.startswith("id,")]
    assert [int(ln.split(",")[0]) for ln in lines] == list(range(1, 2001))
    assert lines[0] == "1,n1,11.50,2024-01-01"


def test_search_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.py").write_text("x = 1\n\ndef main():\n    pass\n")
    (tmp_path / "b.txt").write_text("def main():\n")
    got = files.search_files(spark, str(tmp_path), r"def \w+", "*.py").collect()
    assert [(r.path.rsplit("/", 1)[1], r.line_number, r.line) for r in got] == [("a.py", 3, "def main():")]


def test_rule_precedence(spark):
    df = spark.createDataFrame([("Gold plan",), ("gold",), (None,)], "n string")
    got = [r.c for r in text_rules.classify(df, [("n", "like", "Gold%", "A"), ("n", "regex", "(?i)gold", "B")], "Z", "c").collect()]
    assert got == ["A", "B", "Z"]


def test_available_to_renew_drops_backed_out(spark):
    d = dt.date
    terms = spark.createDataFrame([("s", 1, d(2024, 1, 1), d(2025, 1, 1), None), ("s", 2, d(2023, 6, 1), d(2024, 6, 1), None), ("s", 3, d(2024, 7, 1), d(2025, 7, 1), None)],
                                  "name string, version int, term_start date, term_end date, ramp_id string")
    assert [r.version for r in revenue.available_to_renew(terms, "name", "version", F.col("version")).orderBy("version").collect()] == [2, 3]


def test_critical_path_of_a_deep_graph(spark):
    """Forty levels: the path is put together by doubled pointers."""
    nodes = spark.range(41).select(F.lit(1).alias("run"), F.col("id").alias("node"), F.lit(1.5).alias("cost"))
    edges = spark.range(40).select(F.lit(1).alias("run"), F.col("id").alias("parent"), (F.col("id") + 1).alias("child"))
    shortcuts = spark.range(35).select(F.lit(1).alias("run"), F.col("id").alias("parent"), (F.col("id") + 5).alias("child"))
    got = graphs.critical_path(nodes, edges.unionByName(shortcuts), "run", "node", "cost").collect()
    assert [(r.path_length, r.critical_path) for r in got] == [(60.0, list(range(41)))]


def _random_graphs(spark):
    """Ties, unknown costs, repeated and unlisted nodes, null runs and nodes, runs without edges."""
    draw = random.Random(7)
    nodes, edges = [(None, 1, 1.0), (900, None, 1.0), (901, 5, 2.0)], [(None, 1, 2), (902, 1, 2), (901, None, 5), (901, 7, 5)]
    for run in range(80):
        n = draw.randint(1, 9)
        nodes += [(run, k, None if draw.random() < 0.1 else float(draw.randint(0, 3))) for k in range(n)]
        edges += [(run, a, b) for a in range(n) for b in range(a + 1, n + 1) if draw.random() < 0.35]  # n is a child that isn't listed
    return spark.createDataFrame(nodes, "run int, node long, cost double"), spark.createDataFrame(edges, "run int, parent long, child long")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_critical_path_is_the_same_in_a_task_and_by_rounds(spark, kind):
    nodes, edges = _random_graphs(spark)
    nodes, edges = nodes.withColumn("node", F.col("node").cast(kind)), edges.withColumns({c: F.col(c).cast(kind) for c in ("parent", "child")})
    twice = nodes.unionByName(nodes.where("run % 3 = 0").withColumn("cost", F.lit(-1.0)))
    few, many = (12, 0) if kind == "long" else (0, 12)
    got = [sorted(map(str, graphs.critical_path(x, edges, "run", "node", "cost", most).collect())) for x, n in ((nodes, few), (twice, many)) for most in (300_000, n)]
    assert len(got[0]) == 82 and got[0] == got[1] and got[2] == got[3]


def test_critical_path_takes_no_round_per_level(spark):
    sc = spark.sparkContext
    nodes = spark.range(41).select(F.lit(1).alias("run"), F.col("id").alias("node"), F.lit(1.5).alias("cost"))
    edges = spark.range(40).select(F.lit(1).alias("run"), F.col("id").alias("parent"), (F.col("id") + 1).alias("child"))
    sc.setJobGroup("paths", "paths")
    try:
        assert graphs.critical_path(nodes, edges, "run", "node", "cost").first().path_length == 60.0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("paths")) < 20


def test_critical_path_of_nested_nodes(spark):
    nodes = spark.range(3).select(F.lit(1).alias("run"), F.struct("id").alias("node"), F.lit(1.0).alias("cost"))
    edges = spark.range(2).select(F.lit(1).alias("run"), F.struct("id").alias("parent"), F.struct((F.col("id") + 1).alias("id")).alias("child"))
    r = graphs.critical_path(nodes, edges, "run", "node", "cost").first()
    assert (r.path_length, [x.id for x in r.critical_path]) == (2.0, [0, 1, 2])


def test_whole_runs_are_cut_between_runs():
    rows = [(r, k, None, 1.0, False) for r in range(50) for k in range(3)] + [(r, k, k + 1, None, True) for r in range(50) for k in range(2)]
    t = pa.table(dict(zip(["__run", "__node", "__child", "__cost", "__is_edge"], zip(*sorted(rows, key=lambda x: x[0])))))
    out = pa.Table.from_batches(paths.whole_runs(7)(iter(t.to_batches(max_chunksize=4)))).to_pylist()
    assert out == [{"__run": r, "length": 2.0, "p": [0, 1, 2]} for r in range(50)]
