"""Incremental and streaming upkeep; files."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.operators import usage
from tidemark.plans import inputs as i
from tidemark.plans.registry import query
from tidemark.session import shared_dir
from tidemark.sources import files, tables
from tidemark.streaming import incremental as inc
from tidemark.streaming import log, stateful, streams

r2 = lambda x: F.round(x, 2)


def ntz(x: str):
    return F.expr(f"timestamp_ntz'{x}'")


def scratch(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex[:8]}"


def arrivals(t, df, name: str, start):
    """The events as they would arrive: three drops into a landing folder, the stream run after each.

    The drops are the thirds of the table's own time range; the first and the last are open, so no row is left out.
    """
    base = scratch(t, name)
    land, out, state = f"{base}/land", f"{base}/out", f"{base}/state"
    for n, drop in enumerate(i.thirds(df)):
        drop.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{land}/drop={n}")
        schema = t.spark.read.parquet(f"{land}/drop={n}").schema
        start(streams.stream_files(t.spark, land, schema), out, state)
    return out


@query("stream_merge_sum", covers="T05 T06", sql="""SELECT event_id % 4000 AS clean_id, count(*) AS event_count, max(ts) AS last_loaded_at FROM events WHERE event_type <> 'error' GROUP BY 1""")
def stream_merge_sum(t):
    e = t.events.select((F.col("event_id") % 4000).alias("clean_id"), "ts", "event_type")
    out = arrivals(t, e, "merge-sum", lambda s, o, c: streams.run_to_log(streams.merge_sum_counts(s, "clean_id", "ts", F.col("event_type") != "error"), o, c))
    return streams.read_log(t.spark, out, ["clean_id"]).withColumn("last_loaded_at", F.col("last_loaded_at").cast("timestamp_ntz"))


@query("stream_append", covers="T01 S05", sql="""SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'""")
def stream_append(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    out = arrivals(t, e, "append", lambda s, o, c: streams.run_append(s.where(F.col("event_type") == "purchase").drop("event_type", "drop"), o, c))
    return t.spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_upsert", covers="T02", sql="""SELECT user_id, max(ts) AS last_seen, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1""")
def stream_upsert(t):
    e = t.events.select("user_id", "ts", "event_type")

    def last(s):
        return s.groupBy("user_id").agg(F.max("ts").alias("last_seen"), F.max_by("event_type", "ts").alias("last_type"))

    out = arrivals(t, e, "upsert", lambda s, o, c: streams.run_to_log(last(s), o, c))
    return streams.read_log(t.spark, out, ["user_id"]).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


@query("stream_tumbling_counts", covers="T14 T03", sql="""SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2""")
def stream_tumbling_counts(t):
    e = t.events.select("event_id", "ts", "event_type")
    out = arrivals(t, e, "tumbling", lambda s, o, c: streams.run_to_log(streams.tumbling_counts(s, "ts", "1 day", ["event_type"], "30 days"), o, c))
    return streams.read_log(t.spark, out, ["window_start", "event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_sessions", covers="T13 T07", sql="""WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM g),
x AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM s GROUP BY user_id, n) SELECT * FROM x WHERE session_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)""")
def stream_sessions(t):
    """Sessions the watermark has closed by the end of the data."""
    e = t.events.select("event_id", "user_id", "ts")
    out = arrivals(t, e, "sessions", lambda s, o, c: streams.run_append(streams.sessions(s, "user_id", "ts", "30 minutes", "1 hour"), o, c))
    return t.spark.read.parquet(out).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


def out_of_order(t, df, name: str, start, parts: int = 3):
    """The events as drops that don't follow time: each of them reaches back over the whole range. All but the last are run one by one."""
    base = scratch(t, name)
    land, out, state = f"{base}/land", f"{base}/out", f"{base}/state"
    for n in range(parts):
        df.where(F.col("event_id") % parts == n).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{land}/drop={n}")
        start(streams.stream_files(t.spark, land, t.spark.read.parquet(f"{land}/drop={n}").schema), out, state)
    return out


@query("stream_late_sessions", covers="T07 T13", sql="""WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events FROM s GROUP BY user_id, n""")
def stream_late_sessions(t):
    """Two thirds of the events come after others of the same time have been answered; the log holds what is true in the end."""
    e = t.events.select("event_id", "user_id", "ts")
    out = out_of_order(t, e, "late-sessions", lambda s, o, c: streams.run_to_log(stateful.session_changes(s, "user_id", "ts", 1800, keep_days=60), o, c, "append"))
    done = stateful.settled(t.spark, out, ["user_id", "session_start"])
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "last_event")})


@query("stream_only_once", covers="T08", sql="""WITH e AS (SELECT *, event_id % (SELECT CAST(count(*) * 0.7 AS BIGINT) FROM events) AS clean_id FROM events) SELECT clean_id, min(user_id) AS user_id, min(ts) AS ts FROM e GROUP BY 1 HAVING count(*) = 1""")
def stream_only_once(t):
    """Ids seen once by the end; those repeated by a later drop are taken back."""
    n = t.events.agg((F.count("*") * F.expr("0.7BD")).cast("long").alias("n")).scalar()
    e = t.events.select("event_id", (F.col("event_id") % n).alias("clean_id"), "user_id", "ts")
    out = out_of_order(t, e, "only-once", lambda s, o, c: streams.run_to_log(stateful.once_changes(s.select("clean_id", "user_id", "ts"), "clean_id"), o, c, "append"))
    return stateful.settled(t.spark, out, ["clean_id"]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_compacted_log", covers="T02 T04 T05", sql="""SELECT user_id, count(*) AS events, max(ts) AS last_seen FROM events GROUP BY 1""")
def stream_compacted_log(t):
    """Twelve micro-batches; the log is compacted after seven of them and again at the end."""
    base = scratch(t, "compacted")
    land, out, state = f"{base}/land", f"{base}/out", f"{base}/state"
    e = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    for part in (F.col("event_id") % 12 < 7, F.col("event_id") % 12 >= 7):
        e.where(part).withColumn("drop", F.col("event_id") % 12).repartition("drop").write.mode("append").partitionBy("drop").parquet(land)
        stream = streams.stream_files(t.spark, land, e.schema, files_per_batch=1)
        streams.run_to_log(stream.groupBy("user_id").agg(F.count("*").alias("events"), F.max("ts").alias("last_seen")), out, state)
        log.compact(t.spark, out, ["user_id"])
    return streams.read_log(t.spark, out, ["user_id"]).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))


def dropped(t, day: str):
    return t.events.where(F.col("ts") < ntz(day)), t.events.where(F.col("ts") >= ntz(day))


@query("incremental_append", covers="T01 O02 S14", sql="SELECT event_id, user_id, ts FROM events")
def incremental_append(t):
    e = t.events.select("event_id", "user_id", "ts")
    target = e.where(F.col("ts") < ntz("2024-01-20"))
    return target.unionByName(inc.append_since(e, target, "ts"))


@query("incremental_upsert", covers="T02 T04", sql="""SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events, round(sum(value), 2) AS value FROM events GROUP BY 1, 2""")
def incremental_upsert(t):
    """The boundary day is reprocessed and replaces what was stored for it."""
    agg = lambda d: d.groupBy("user_id", i.day("ts").alias("day")).agg(F.count("*").alias("events"), r2(F.sum("value")).alias("value"))
    old = agg(t.events.where(F.col("ts") < ntz("2024-01-20 15:00:00")))
    return inc.upsert(old, agg(t.events.where(F.col("ts") >= ntz("2024-01-20"))), ["user_id", "day"])


def bucketed(t, df, keys: list[str], buckets: int = 8) -> str:
    name = f"tm_{uuid.uuid4().hex}"
    tables.write_bucketed(df, name, scratch(t, "bucketed"), keys, buckets)
    return name


@query("bucketed_upsert", covers="T02 T18", sql="""SELECT o_orderkey, o_custkey, round(CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice * 2 ELSE o_totalprice END, 2) AS o_totalprice FROM orders""")
def bucketed_upsert(t):
    """A stored table of orders; changed and new ones are merged in, version by version, without moving the stored ones."""
    o = t.orders.select("o_orderkey", "o_custkey", r2("o_totalprice").alias("o_totalprice"))
    k = F.col("o_orderkey")
    name, after = bucketed(t, o.where(k % 7 != 0), ["o_orderkey"]), f"tm_{uuid.uuid4().hex}"
    tables.rewrite_bucketed(t.spark, name, o.where(k % 7 == 0), ["o_orderkey"], 8, scratch(t, "bucketed"), after)
    doubled = t.orders.where(k % 10 == 0).select("o_orderkey", "o_custkey", r2(F.col("o_totalprice") * 2).alias("o_totalprice"))
    return tables.upsert_bucketed(t.spark, after, doubled, ["o_orderkey"])


@query("bucketed_stale_rows", covers="P08", sql="""SELECT o_orderkey, o_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'OLD' ELSE c_mktsegment END AS c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 13 = 0 AND c_mktsegment <> 'OLD'""")
def bucketed_stale_rows(t):
    stored = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", F.when(F.col("c_custkey") % 13 == 0, "OLD").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    fact = bucketed(t, stored, ["o_custkey"])
    dim = bucketed(t, t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), ["o_custkey"])
    return tables.stale_rows(t.spark, fact, dim, "o_custkey", ["c_mktsegment"])


@query("incremental_delete_insert", covers="T04 T07", sql=f"""WITH {i.SQL_SESSIONED} SELECT user_id, count(DISTINCT session_index) AS sessions, count(*) AS events FROM sessioned GROUP BY 1""")
def incremental_delete_insert(t):
    def build(d):
        return usage.sessionize(d, "user_id", "ts", "event_id").groupBy("user_id").agg(F.countDistinct("session_index").alias("sessions"), F.count("*").alias("events"))

    old = build(t.events.where(F.col("ts") < ntz("2024-01-25")))
    again = inc.touched(t.events, ntz("2024-01-24 23:59:59.999999"), "ts", ["user_id"])
    return inc.delete_insert(old, build(again), ["user_id"])


@query("incremental_merge_sum", covers="T05", sql="""SELECT event_id % 3000 AS clean_id, count(*) AS event_count, max(ts) AS last_loaded_at FROM events WHERE event_type <> 'error' GROUP BY 1""")
def incremental_merge_sum(t):
    ok = F.col("event_type") != "error"
    a, b = (d.withColumn("clean_id", F.col("event_id") % 3000) for d in dropped(t, "2024-01-16"))
    return inc.merge_sum(inc.event_counts(a, "clean_id", "ts", ok), inc.event_counts(b, "clean_id", "ts", ok), ["clean_id"], ["event_count"], ["last_loaded_at"])


@query("only_once", covers="T08", sql="""WITH e AS (SELECT *, event_id % (SELECT CAST(count(*) * 0.7 AS BIGINT) FROM events) AS clean_id FROM events) SELECT clean_id, min(user_id) AS user_id, min(ts) AS ts FROM e GROUP BY 1 HAVING count(*) = 1""")
def only_once(t):
    n = t.events.agg((F.count("*") * F.expr("0.7BD")).cast("long").alias("n")).scalar()
    e = t.events.select((F.col("event_id") % n).alias("clean_id"), "user_id", "ts")
    return inc.only_once(e, inc.event_counts(e, "clean_id", "ts", F.lit(True)), "clean_id")


@query("lookback_window", covers="T03", sql="SELECT event_id, ts FROM events WHERE ts >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events WHERE ts < TIMESTAMP '2024-01-20')")
def lookback_window(t):
    e = t.events.select("event_id", "ts")
    return inc.lookback(e, e.where(F.col("ts") < ntz("2024-01-20")), "ts", 7)


@query("rolling_retention", covers="T09 T10", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '2001-12-31' - INTERVAL 24 MONTH AND o_orderstatus <> 'F'")
def rolling_retention(t):
    o = t.orders.select("o_orderkey", i.day("o_orderdate").alias("day"), (F.col("o_orderstatus") != "F").alias("is_current"))
    return inc.current_only(inc.rolling_window(o, "day", "month", 24, F.lit(i.ORDERS_AS_OF)), "is_current").drop("is_current")


@query("unmapped_keys", covers="T18", sql="SELECT DISTINCT l_partkey AS part_id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)")
def unmapped_keys(t):
    return inc.unmapped(t.lineitem.select(F.col("l_partkey").alias("part_id")), t.part.where(F.col("p_size") < 40).select(F.col("p_partkey").alias("part_id")), ["part_id"])


@query("snapshot_accretion", covers="T19", sql="SELECT CAST(ts AS DATE) AS snapshot_date, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def snapshot_accretion(t):
    s = t.events.groupBy(i.day("ts").alias("snapshot_date"), "event_type").agg(F.count("*").alias("n"))
    stored = s.where(F.col("snapshot_date") <= F.lit(dt.date(2024, 1, 20))).withColumn("n", F.when(F.col("snapshot_date") == F.lit(dt.date(2024, 1, 20)), F.lit(0)).otherwise(F.col("n")))
    return inc.accrete(stored, s.where(F.col("snapshot_date") >= F.lit(dt.date(2024, 1, 20))), "snapshot_date")


@query("month_partitions", covers="T12 S10 S11", sql="SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS amount FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '1999-01' GROUP BY 1")
def month_partitions(t):
    path = scratch(t, "months")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    inc.write_month_partitions(o.where(F.col("o_orderdate") < ntz("2000-06-15")), "o_orderdate", path)
    inc.write_month_partitions(o.where(F.col("o_orderdate") >= ntz("2000-06-01")), "o_orderdate", path)
    read = t.spark.read.schema("o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE, month STRING").parquet(path)
    return read.where(F.col("month") >= "1999-01").groupBy("month").agg(F.count("*").alias("orders"), r2(F.sum("o_totalprice")).alias("amount"))


# --- files ----------------------------------------------------------------------------------------

@query("typed_source", covers="S01 F07", sql="SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS amount, CAST(o_orderdate AS DATE) AS ordered_on FROM orders WHERE o_orderstatus <> 'P'")
def typed_source(t):
    raw = t.orders.withColumn("is_deleted", F.col("o_orderstatus") == "P")
    s = files.typed_source(raw, {"id": ("o_orderkey", "string"), "amount": ("o_totalprice", "decimal(12,2)"), "ordered_on": ("o_orderdate", "date")}, "is_deleted")
    return s.withColumn("amount", F.col("amount").cast("double"))


@query("sheet_upload", covers="S06 A12", sql="SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS balance FROM customer")
def sheet_upload(t):
    path = scratch(t, "sheet")
    t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).otherwise("").alias("segment"),
                      F.when(F.col("c_custkey") % 5 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance")).write.csv(path, header=True)
    return files.read_sheet(t.spark, path, {"c_custkey": "bigint", "segment": "string", "balance": "double"})


@query("json_partitions", covers="S04", sql="SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS date_part FROM events WHERE ts >= DATE '2024-01-15'")
def json_partitions(t):
    path = scratch(t, "json")
    t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), i.day("ts").alias("date_part")).write.partitionBy("date_part").json(path)
    return files.read_json_partitions(t.spark, path, "event_id BIGINT, k INT", "date_part", "2024-01-15")


@query("object_list_feed", covers="S07", sql="SELECT c_mktsegment AS segment, c_custkey AS id, c_name AS name FROM customer")
def object_list_feed(t):
    """Lists stay short: one list per segment and block of a hundred customers."""
    feed = t.customer.groupBy("c_mktsegment", F.floor(F.col("c_custkey") / 100).alias("b")).agg(F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))).alias("body"))
    return files.explode_feed(feed.select(F.col("c_mktsegment").alias("segment"), "body"), "body", "id BIGINT, name STRING")


@query("inline_values", covers="S08 S12 S13 S15", sql="SELECT label, count(*) AS orders FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) v(code, label) ON o_orderstatus = code GROUP BY 1")
def inline_values(t):
    t.orders.createOrReplaceTempView("tm_orders")
    return t.spark.sql("SELECT label, count(*) AS orders FROM tm_orders JOIN VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial') AS v(code, label) ON o_orderstatus = code GROUP BY label")


@query("changed_rows_feed", covers="S16 F11", sql="SELECT c_custkey, c_name, DATE '2001-12-31' AS run_date FROM customer WHERE c_custkey % 5 = 0 AND regexp_full_match(c_name, 'Customer#[0-9]+')")
def changed_rows_feed(t):
    from tidemark.functions.scalars import regexp_full
    c = t.customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 5 == 0, F.lit(i.ORDERS_AS_OF)).otherwise(F.lit(dt.date(2001, 1, 1))).alias("last_changed"))
    path = scratch(t, "feed")
    files.write_feed(files.changed_rows(c, "last_changed", i.ORDERS_AS_OF, regexp_full("c_name", "Customer#[0-9]+")).drop("last_changed"), path, i.ORDERS_AS_OF)
    return t.spark.read.schema("c_custkey BIGINT, c_name STRING, run_date DATE").json(path)


@query("mail_list", covers="S17 S19", sql="SELECT c_nationkey, max(c_name) AS c_name, c_mktsegment FROM (SELECT c_nationkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0 QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name DESC, c_mktsegment DESC) = 1) GROUP BY c_nationkey, c_mktsegment")
def mail_list(t):
    m = files.mail_list(t.customer, "c_nationkey", "c_acctbal", ["c_name", "c_mktsegment"], F.col("c_acctbal") > 0)
    return files.share_view(m, ["c_nationkey", "c_name", "c_mktsegment"])


CSV_COLUMNS = {"id": "BIGINT", "name": "STRING", "purchase_amount": "DECIMAL(12,2)", "purchase_date": "DATE"}


def csv_fixture(t):
    path = scratch(t, "csv")
    t.orders.select((F.col("o_orderkey") + 1).alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").cast("decimal(12,2)").alias("purchase_amount"),
                    i.day("o_orderdate").alias("purchase_date")).write.csv(f"{path}/in", header=True)
    files.csv_update(t.spark, f"{path}/in", f"{path}/out", CSV_COLUMNS, "id", "purchase_amount", lambda x: x + 10)
    return path


def csv_read(t, path):
    return t.spark.read.csv(path, header=True, schema=", ".join(f"{c} {k}" for c, k in CSV_COLUMNS.items()))


@query("csv_update", covers="P97 S20", sql="SELECT o_orderkey + 1 AS id, o_orderpriority AS name, round(o_totalprice + 10, 2) AS purchase_amount, CAST(o_orderdate AS DATE) AS purchase_date FROM orders")
def csv_update(t):
    return csv_read(t, csv_fixture(t) + "/out").withColumn("purchase_amount", F.col("purchase_amount").cast("double"))


@query("sampled_diff", covers="P98", sql="SELECT count(*) FILTER (o_orderkey % 100 = 0) AS checked, 0 AS differing, 0 AS missing, count(*) AS rows_before, count(*) AS rows_after FROM orders")
def sampled_diff(t):
    path = csv_fixture(t)
    return files.sampled_diff(csv_read(t, f"{path}/in"), csv_read(t, f"{path}/out"), "id", "purchase_amount", lambda x: x + 10, 100, 0.01)
