"""Effective-dated history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import calendar, history, ordered
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

r2 = lambda x: F.round(x, 2)


@query("collapse_plan_history", covers="P23 W15 W05", sql=f"""WITH {i.SQL_PLAN_HISTORY},
f AS (SELECT *, CASE WHEN value IS DISTINCT FROM lag(value) OVER (PARTITION BY key ORDER BY valid_from) THEN 1 ELSE 0 END AS o FROM plan_history),
g AS (SELECT *, sum(o) OVER (PARTITION BY key ORDER BY valid_from ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT key, value, min(valid_from) AS valid_from, CASE WHEN count(*) = count(valid_to) THEN max(valid_to) END AS valid_to, count(*) AS merged_rows FROM g GROUP BY key, value, island""")
def collapse_plan_history(t):
    return history.collapse_scd(i.plan_history(t), ["key"], ["value"], "valid_from", "valid_to")


@query("order_with_valid_plan", covers="P24 J11", sql=f"""WITH {i.SQL_PLAN_HISTORY}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, CAST(l_shipdate AS DATE) AS ship_date, value AS priority_then FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN plan_history ON key = o_custkey AND CAST(l_shipdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(l_shipdate AS DATE) < valid_to)""")
def order_with_valid_plan(t):
    fact = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", i.day("l_shipdate").alias("ship_date"))
    dim = i.plan_history(t).select(F.col("key").alias("o_custkey"), F.col("value").alias("priority_then"), "valid_from", "valid_to")
    return history.asof_scd(fact, dim, "o_custkey", "ship_date", ["priority_then"], "valid_from", "valid_to")


@query("purchase_last_view", covers="P75 J12", sql="""SELECT p.event_id, p.user_id, p.ts, v.event_id AS view_id, v.value AS view_value FROM events p
LEFT JOIN events v ON v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts
WHERE p.event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC NULLS LAST) = 1""")
def purchase_last_view(t):
    fact = t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    views = t.events.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("seen"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return history.asof_scd(fact, views, "user_id", "ts", ["view_id", "view_value"], "seen", None)


@query("plan_snapshots", covers="P22 T19", sql=f"""WITH {i.SQL_PLAN_HISTORY}, months AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS snapshot_date)
SELECT snapshot_date, value, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM plan_history JOIN months ON valid_from <= snapshot_date AND (valid_to IS NULL OR snapshot_date < valid_to)
JOIN customer ON c_custkey = key GROUP BY 1, 2, 3""")
def plan_snapshots(t):
    s = history.snapshot_series(i.plan_history(t), "valid_from", "valid_to", i.ORDERS_AS_OF)
    return s.join(t.customer, F.col("key") == F.col("c_custkey")).groupBy("snapshot_date", "value", "c_mktsegment").agg(
        F.count("*").alias("customers"), r2(F.sum("c_acctbal")).alias("balance"))


@query("scd_latest_state", covers="P25 M05 T10", sql="""WITH loads AS (SELECT user_id, CAST(ts AS DATE) AS loaded_at, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, loaded_at, n, loaded_at < (SELECT max(loaded_at) FROM loads) AS is_deleted FROM loads QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY loaded_at DESC) = 1""")
def scd_latest_state(t):
    loads = t.events.groupBy("user_id", i.day("ts").alias("loaded_at")).agg(F.count("*").alias("n"))
    return history.scd_latest_state(loads, "user_id", "loaded_at")


@query("scd_type_2_daily", covers="P02 P23", sql="""WITH loads AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, (ts, event_id)) AS state FROM events GROUP BY 1, 2),
n AS (SELECT *, lead(d) OVER w AS nx, CASE WHEN state IS DISTINCT FROM lag(state) OVER w THEN 1 ELSE 0 END AS o FROM loads WINDOW w AS (PARTITION BY user_id ORDER BY d)),
g AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT user_id, state, min(d) AS valid_from, CASE WHEN count(*) = count(nx) THEN max(nx) END AS valid_to, count(*) AS merged_rows FROM g GROUP BY user_id, state, island""")
def scd_type_2_daily(t):
    loads = t.events.groupBy("user_id", i.day("ts").alias("loaded_at")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"))
    return history.scd_type_2(loads, "user_id", ["state"], "loaded_at")


@query("field_history", covers="P26", sql="""SELECT event_id, user_id, event_type AS field, value, ts, lag(value) OVER w AS previous_value, lag(ts) OVER w AS previous_at, lead(ts) OVER w AS valid_to
FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)""")
def field_history(t):
    audit = t.events.select("event_id", "user_id", F.col("event_type").alias("field"), "value", "ts")
    return history.versions_to_history(audit, ["user_id", "field"], ["ts", "event_id"], "value")


@query("order_state_on_day", covers="P80", sql=f"""WITH {i.SQL_PLAN_HISTORY},
o AS (SELECT o_orderkey, o_custkey AS key, CAST(o_orderdate AS DATE) AS opened, max(CAST(l_shipdate AS DATE)) AS closed FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
x AS (SELECT *, CAST(unnest(generate_series(opened, CAST(closed - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM o WHERE closed > opened)
SELECT day, value AS label, count(*) AS open_orders, sum(date_diff('day', opened, day))::BIGINT AS total_age FROM x LEFT JOIN plan_history p ON p.key = x.key AND day >= valid_from AND (valid_to IS NULL OR day < valid_to) GROUP BY 1, 2""")
def order_state_on_day(t):
    ship = t.lineitem.groupBy("l_orderkey").agg(F.max(i.day("l_shipdate")).alias("closed"))
    o = t.orders.join(ship, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", F.col("o_custkey").alias("key"), i.day("o_orderdate").alias("opened"), "closed")
    pieces = history.state_intervals(o, i.plan_history(t).withColumnRenamed("value", "label"), "key", "opened", "closed", i.ORDERS_AS_OF, "label", "valid_from", "valid_to")
    return calendar.open_per_day(pieces, ["label"], "open_from", "open_to", i.ORDERS_AS_OF, "opened").withColumnRenamed("open_count", "open_orders")


@query("union_event_partitions", covers="P87 S10 U04 U05 T03", sql="""SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-05'""")
def union_event_partitions(t):
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    # neighbouring parts overlap by a day, as reprocessed partitions do; the first and the last are open
    parts = i.thirds(e, dt.timedelta(days=1))
    return history.union_partitions(parts, "event_id", "ts", dt.date(2024, 1, 5))


@query("merge_histories", covers="P105 W08", sql="""WITH a AS (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS start, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
b AS (SELECT o_custkey AS key, CAST(l_shipdate AS DATE) AS start, max(l_returnflag) AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
d AS (SELECT coalesce(a.key, b.key) AS key, coalesce(a.start, b.start) AS start, priority, flag FROM a FULL JOIN b ON a.key = b.key AND a.start = b.start),
f AS (SELECT key, start, last_value(priority IGNORE NULLS) OVER w AS priority, last_value(flag IGNORE NULLS) OVER w AS flag FROM d WINDOW w AS (PARTITION BY key ORDER BY start ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, lead(start) OVER w AS nx, CASE WHEN row_number() OVER w = 1 OR priority IS DISTINCT FROM lag(priority) OVER w OR flag IS DISTINCT FROM lag(flag) OVER w THEN 1 ELSE 0 END AS o FROM f WINDOW w AS (PARTITION BY key ORDER BY start)),
g AS (SELECT *, sum(o) OVER (PARTITION BY key ORDER BY start ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT key, priority, flag, min(start) AS start, CASE WHEN count(*) = count(nx) THEN max(nx) END AS valid_to FROM g GROUP BY key, priority, flag, island""")
def merge_histories(t):
    a = t.orders.select(F.col("o_custkey").alias("key"), i.day("o_orderdate").alias("start"), F.col("o_orderpriority").alias("priority"))
    b = i.order_lines(t).select(F.col("o_custkey").alias("key"), i.day("l_shipdate").alias("start"), F.col("l_returnflag").alias("flag"))
    return history.merge_histories(a, b, "key", "start", ["priority"], ["flag"])


CUT_OVER = dt.date(1997, 3, 1)


@query("merge_histories_cut_over", covers="P105 W08", sql=f"""WITH a AS (SELECT o_custkey AS key, CAST(o_orderdate AS DATE) AS start, max(o_orderpriority) AS priority FROM orders WHERE o_orderdate < DATE '{CUT_OVER}' GROUP BY 1, 2),
b AS (SELECT key, greatest(start, DATE '{CUT_OVER}') AS start, arg_max(flag, start) AS flag FROM (SELECT o_custkey AS key, CAST(l_shipdate AS DATE) AS start, max(l_returnflag) AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1, 2),
d AS (SELECT key, start, max(priority) AS priority, max(flag) AS flag FROM (SELECT key, start, priority, NULL AS flag FROM a UNION ALL SELECT key, start, NULL, flag FROM b UNION ALL SELECT DISTINCT o_custkey, DATE '{CUT_OVER}', NULL, NULL FROM orders) GROUP BY 1, 2),
f AS (SELECT key, start, CASE WHEN start < DATE '{CUT_OVER}' THEN last_value(priority IGNORE NULLS) OVER w END AS priority, CASE WHEN start >= DATE '{CUT_OVER}' THEN last_value(flag IGNORE NULLS) OVER w END AS flag FROM d WINDOW w AS (PARTITION BY key ORDER BY start ROWS UNBOUNDED PRECEDING)),
n AS (SELECT *, lead(start) OVER w AS nx, CASE WHEN row_number() OVER w = 1 OR priority IS DISTINCT FROM lag(priority) OVER w OR flag IS DISTINCT FROM lag(flag) OVER w THEN 1 ELSE 0 END AS o FROM f WINDOW w AS (PARTITION BY key ORDER BY start)),
g AS (SELECT *, sum(o) OVER (PARTITION BY key ORDER BY start ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT key, priority, flag, min(start) AS start, CASE WHEN count(*) = count(nx) THEN max(nx) END AS valid_to FROM g GROUP BY key, priority, flag, island""")
def merge_histories_cut_over(t):
    """Priorities until the cut-over, return flags from then on, the one known by then first."""
    a = t.orders.select(F.col("o_custkey").alias("key"), i.day("o_orderdate").alias("start"), F.col("o_orderpriority").alias("priority"))
    b = i.order_lines(t).select(F.col("o_custkey").alias("key"), i.day("l_shipdate").alias("start"), F.col("l_returnflag").alias("flag"))
    return history.merge_histories(a, b, "key", "start", ["priority"], ["flag"], cut_over=CUT_OVER)


@query("history_plus_current", covers="P113", sql="""SELECT month, source, round(sum(amount), 2) AS amount FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, 'history' AS source, o_totalprice AS amount FROM orders WHERE o_orderdate < DATE '2001-07-01'
UNION ALL SELECT CAST(date_trunc('month', o_orderdate) AS DATE), 'live', o_totalprice FROM orders WHERE o_orderdate >= DATE '2001-07-01') GROUP BY 1, 2""")
def history_plus_current(t):
    cut = F.lit(dt.date(2001, 7, 1))
    o = t.orders.select(i.month("o_orderdate").alias("month"), "o_orderdate", F.col("o_totalprice").alias("amount"))
    closed = o.where(F.col("o_orderdate") < cut).withColumn("source", F.lit("history"))
    live = o.where(F.col("o_orderdate") >= cut).withColumn("source", F.lit("live"))
    return closed.unionByName(live).groupBy("month", "source").agg(r2(F.sum("amount")).alias("amount"))
