"""Compacted logs, state of one's own in streams, bucketed tables."""

import datetime as dt
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources import tables
from tidemark.streaming import log, stateful, streams


def place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def test_two_hundred_batches_are_few_runs():
    runs = []
    for n in range(200):
        runs = log.tiers(runs, [n])
        assert [r[0] for r in runs] == [0, *[r[1] + 1 for r in runs[:-1]]] and runs[-1][1] == n
        assert len(runs) <= (n + 1).bit_length()
    assert runs == log.tiers([], range(200)) and len(runs) <= 8


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_compaction_keeps_rows_and_readers(spark):
    path, r, want = place(spark, "log"), random.Random(1), {}
    for n in range(23):
        rows = [(r.randrange(40), n * 100 + k) for k in range(5)]
        want |= {k: max(v for k2, v in rows if k2 == k) for k, _ in rows}
        spark.createDataFrame([(k, want[k]) for k in {k for k, _ in rows}], "k int, v int").coalesce(1).write.parquet(f"{path}/batch={n}")
        if n in (6, 7, 15):
            reader = log.read(spark, path, ["k"])
            assert log.compact(spark, path, ["k"]) <= n.bit_length()
            assert rows_of(reader) == rows_of(log.read(spark, path, ["k"])) == sorted(want.items())  # one that was planned before still reads
    whole = rows_of(log.read(spark, path, ["k"]))
    files = log._Files(spark, path)
    runs = log._runs(files)
    assert whole == sorted(want.items()) and runs[-1]["last"] == 14 and len(runs) == 4  # 15 batches: 8 + 4 + 2 + 1
    spark.range(1).selectExpr("1 AS k", "7 AS v").write.mode("overwrite").parquet(f"{path}/batch=22")  # the newest batch written again
    want[1] = 7
    assert log.compact(spark, path, ["k"]) <= 5
    log.vacuum(spark, path, 1)
    assert [n for n in files.names() if n.startswith("batch=")] == ["batch=22"]
    assert {k: v for k, v in rows_of(log.read(spark, path, ["k"])) if k == 1} == {1: 7}


def test_only_one_compaction_is_published(spark):
    path = place(spark, "log")
    for n in range(4):
        spark.range(2).write.parquet(f"{path}/batch={n}")
    files = log._Files(spark, path)
    files.publish("[]", "_manifest/0000000000")
    with pytest.raises(RuntimeError):
        files.publish("[]", "_manifest/0000000000")
    assert log.compact(spark, path) == 2 and log.read(spark, path).count() == 8
    assert not [n for n in files.names("_manifest") if n.startswith(".") and not n.endswith(".crc")]


def at(minute):
    return dt.datetime(2024, 3, 1) + dt.timedelta(minutes=minute)


def run(spark, base, drops, changes, n):
    land = f"{base}/land"
    drops.coalesce(1).write.parquet(f"{land}/drop={n}")
    stream = streams.stream_files(spark, land, drops.schema)
    streams.run_to_log(changes(stream), f"{base}/out", f"{base}/state", "append")
    return f"{base}/out"


def test_late_events_change_sessions(spark):
    base = place(spark, "late")
    schema = "u int, ts timestamp"

    def drop(n, rows):
        df = spark.createDataFrame([(u, at(m) if m is not None else None) for u, m in rows], schema)
        out = run(spark, base, df, lambda s: stateful.session_changes(s, "u", "ts", 600, keep_days=1), n)
        return sorted((r.u, (r.session_start - at(0)).total_seconds() / 60, r.events) for r in stateful.settled(spark, out, ["u", "session_start"]).collect())

    assert drop(0, [(1, 0), (1, 5), (1, 100), (2, 0), (1, None), (None, 3)]) == [(1, 0, 2), (1, 100, 1), (2, 0, 1)]
    assert drop(1, [(1, 95), (3, 50000)]) == [(1, 0, 2), (1, 95, 2), (2, 0, 1), (3, 50000, 1)]  # an earlier event moves a start
    assert drop(2, [(1, m) for m in range(14, 95, 9)]) == [(1, 0, 13), (2, 0, 1), (3, 50000, 1)]  # a bridge joins two
    assert drop(3, [(3, 3), (1, 3000)]) == [(1, 0, 13), (1, 3000, 1), (2, 0, 1), (3, 3, 1), (3, 50000, 1)]
    # two days on, what ended before left the state: an event beside it opens a session of its own
    assert drop(4, [(1, 96)]) == [(1, 0, 13), (1, 96, 1), (1, 3000, 1), (2, 0, 1), (3, 3, 1), (3, 50000, 1)]


def test_repeated_ids_are_taken_back(spark):
    base = place(spark, "once")

    def drop(n, rows):
        df = spark.createDataFrame(rows, "id int, v string, x double")
        out = run(spark, base, df, lambda s: stateful.once_changes(s, "id"), n)
        return sorted((r.id, r.v, r.x) for r in stateful.settled(spark, out, ["id"]).collect())

    assert drop(0, [(1, "a", 1.5), (2, "b", 2.5), (2, "c", 0.0), (4, "d", 4.5)]) == [(1, "a", 1.5), (4, "d", 4.5)]
    assert drop(1, [(1, "a", 1.5), (3, "e", 3.5)]) == [(3, "e", 3.5), (4, "d", 4.5)]
    assert drop(2, [(1, "a", 1.5), (2, "f", 1.0), (3, "g", 0.5)]) == [(4, "d", 4.5)]


def test_idle_keys_are_forgotten(spark):
    base = place(spark, "idle")

    def drop(n, rows):
        df = spark.createDataFrame(rows, "id int, v int")
        out = run(spark, base, df, lambda s: stateful.once_changes(s, "id", idle_ms=500), n)
        return sorted(r.id for r in stateful.settled(spark, out, ["id"]).collect())

    assert drop(0, [(1, 0)]) == [1]
    time.sleep(2)
    assert drop(1, [(2, 0)]) == [1, 2]  # the timer of 1 goes off in this batch
    assert drop(2, [(1, 0)]) == [1, 2]  # so 1 is new again


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_stored_side_of_an_upsert_does_not_move(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name, path = f"tm_{uuid.uuid4().hex}", place(spark, "bucketed")
        old = spark.range(5000).select((F.col("id") % 4000).alias("k"), F.lit("old").alias("v")).distinct()
        tables.write_bucketed(old, name, path, ["k"], 8)
        new = spark.range(0, 6000, 3).select(F.col("id").alias("k"), F.lit("new").alias("v"))
        merged = tables.upsert_bucketed(spark, name, new, ["k"])
        assert {(r.v, r["count"]) for r in merged.groupBy("v").count().collect()} == {("old", 4000 - 1334), ("new", 2000)}
        plan = merged._jdf.queryExecution().sparkPlan().toString()
        assert "Bucketed: true" in merged._jdf.queryExecution().executedPlan().toString() and "SortMergeJoin" in plan
        text = plan_of(merged).split("Initial Plan")[0]
        side = text[text.index("LeftAnti"):text.index("Bucketed: true")]
        assert "Exchange" not in side  # nothing between the scan of the stored side and the join
        after = tables.rewrite_bucketed(spark, name, new, ["k"], 8, place(spark, "bucketed"), f"{name}_2")
        assert rows_of(after) == rows_of(merged)
        dim = f"{name}_3"
        tables.write_bucketed(spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") < 10, "x").otherwise("old").alias("v")), dim, place(spark, "bucketed"), ["k"], 8)
        stale = tables.stale_rows(spark, name, dim, "k", ["v"])
        assert stale.count() == 10 and "Exchange hashpartitioning(k" not in plan_of(stale)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_streamed_log_reads_like_a_table(spark):
    base = place(spark, "sums")
    for n in range(5):
        df = spark.createDataFrame([(k, n) for k in range(n + 1)], "k int, v int")
        df.coalesce(1).write.parquet(f"{base}/land/drop={n}")
        stream = streams.stream_files(spark, f"{base}/land", df.schema)
        streams.run_to_log(stream.groupBy("k").agg(F.count("*").alias("n")), f"{base}/out", f"{base}/state")
        log.compact(spark, f"{base}/out", ["k"])
    assert rows_of(streams.read_log(spark, f"{base}/out", ["k"])) == [(k, 5 - k) for k in range(5)]
