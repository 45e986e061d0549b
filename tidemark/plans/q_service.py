"""Support, engineering, people; quality and reshaping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import calendar, ordered, quality, service
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

r2 = lambda x: F.round(x, 2)
r6 = lambda x: F.round(x, 6)


@query("first_response", covers="P76 M05", sql="""WITH c AS (SELECT conv_id, min(turn) FILTER (role = 'assistant') AS a, min(turn) FILTER (role = 'system') AS b, max(turn) AS n FROM conversations GROUP BY 1)
SELECT conv_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b, n) END AS first_response, least(a, b, n) AS first_response_any FROM c""")
def first_response(t):
    c = t.conversations.groupBy("conv_id").agg(F.min(F.when(F.col("role") == "assistant", F.col("turn"))).alias("a"), F.min(F.when(F.col("role") == "system", F.col("turn"))).alias("b"), F.max("turn").alias("n"))
    return service.first_response(c, ["a", "b", "n"]).drop("a", "b", "n")


@query("lead_times", covers="P77 A22", sql="""WITH j AS (SELECT CAST(l_shipdate AS DATE) AS d, date_diff('second', o_orderdate, l_shipdate) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'month' AS grain, CAST(date_trunc('month', d) AS DATE) AS period, round(sum(s) / count(*) / 3600, 6) AS mean_hours, count(*) AS items FROM j GROUP BY 2 UNION ALL SELECT 'day', d, round(sum(s) / count(*) / 3600, 6), count(*) FROM j GROUP BY 2""")
def lead_times(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return service.lead_times(j, "o_orderdate", "l_shipdate").withColumn("mean_hours", r6("mean_hours"))


@query("breakout", covers="P79 A22 A23", sql="""SELECT CASE WHEN grouping(r_name) = 0 AND grouping(n_name) = 0 THEN 'r_name+n_name' WHEN grouping(r_name) = 0 THEN 'r_name' WHEN grouping(c_mktsegment) = 0 THEN 'c_mktsegment' ELSE 'all' END AS breakout, r_name, n_name, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY GROUPING SETS ((r_name), (r_name, n_name), (c_mktsegment), ())""")
def breakout(t):
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return service.breakout(j, [["r_name"], ["r_name", "n_name"], ["c_mktsegment"]], {"customers": F.count("*"), "balance": r2(F.sum("c_acctbal"))})


@query("rolling_rate", covers="P42 W11", sql="""WITH g AS (SELECT c_mktsegment AS segment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS base, count(*) FILTER (o_orderstatus = 'P') AS leavers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
s AS (SELECT segment, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM g GROUP BY 1), d AS (SELECT s.segment, s.month, coalesce(base, 0) AS base, coalesce(leavers, 0) AS leavers FROM s LEFT JOIN g USING (segment, month)),
r AS (SELECT *, avg(base) OVER w AS rolling_base, CAST(sum(leavers) OVER w AS BIGINT) AS rolling_leavers FROM d WINDOW w AS (PARTITION BY segment ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT segment, month, round(rolling_base, 6) AS rolling_base, rolling_leavers, CASE WHEN rolling_base >= rolling_leavers THEN round(1 - rolling_leavers / nullif(rolling_base, 0), 6) END AS retention_rate FROM r""")
def rolling_rate(t):
    g = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment"), i.month("o_orderdate").alias("month")).agg(
        F.count("*").alias("base"), F.count_if(F.col("o_orderstatus") == "P").alias("leavers"))
    d = calendar.densify(g, ["segment"], "month", 0, ["base", "leavers"])
    r = service.rolling_rate(d, ["segment"], "month", "base", "leavers")
    return r.select("segment", "month", r6("rolling_base").alias("rolling_base"), "rolling_leavers", r6("retention_rate").alias("retention_rate"))


@query("nps", covers="P67 A20", sql="""WITH s AS (SELECT p_brand, p_size % 11 AS x FROM part) SELECT p_brand, round(avg(CASE WHEN x >= 9 THEN 100 WHEN x >= 7 THEN 0 ELSE -100 END), 6) AS nps, count(*) AS responses, count(*) FILTER (x >= 9) AS promoters, count(*) FILTER (x IN (7, 8)) AS passives, count(*) FILTER (x < 7) AS detractors FROM s GROUP BY 1""")
def nps(t):
    return service.nps(t.part.withColumn("x", F.col("p_size") % 11), ["p_brand"], "x").withColumn("nps", r6("nps"))


@query("scorecard", covers="P70 A11 A28", sql="""WITH m AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, round(sum(l_extendedprice), 2) AS revenue, CAST(count(*) AS DOUBLE) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2),
u AS (SELECT year, 'revenue' AS metric, revenue AS value FROM m UNION ALL SELECT year, 'lines', lines FROM m UNION ALL SELECT year, 'quantity', quantity FROM m), c AS (SELECT year, metric, quantile_cont(value, 0.1) AS cut FROM u GROUP BY 1, 2)
SELECT year, metric, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75, round(quantile_cont(value, 0.8), 4) AS p80, round(quantile_cont(value, 0.9), 4) AS p90, round(max(value), 4) AS p100 FROM u JOIN c USING (year, metric) WHERE value > cut GROUP BY 1, 2""")
def scorecard(t):
    m = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(r2(F.sum("l_extendedprice")).alias("revenue"), F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    s = service.scorecard(m, ["l_suppkey", "year"], ["revenue", "lines", "quantity"], {"p25": .25, "p50": .5, "p75": .75, "p80": .8, "p90": .9, "p100": 1.0}, ["year"])
    return s.select("year", "metric", *[F.round(c, 4).alias(c) for c in s.columns[2:]])


@query("price_quantiles", covers="A10 A11", sql="""SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem GROUP BY 1, 2""")
def price_quantiles(t):
    q = ordered.quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p50": .5, "p90": .9, "p99": .99})
    return q.select("l_returnflag", "l_linestatus", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p99")])


@query("percent_rank_threshold", covers="P71 W04", sql="""SELECT o_orderkey, month, round(percent_rank, 6) AS percent_rank FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, percent_rank() OVER (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_totalprice) AS percent_rank FROM orders) WHERE percent_rank <= 0.85""")
def percent_rank_threshold(t):
    o = t.orders.select("o_orderkey", i.month("o_orderdate").alias("month"), "o_totalprice")
    return service.percent_rank_threshold(o, ["month"], "o_totalprice", 0.85).select("o_orderkey", "month", r6("percent_rank").alias("percent_rank"))


@query("zscore", covers="P69 A14", sql="""SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER p) / nullif(stddev_samp(c_acctbal) OVER p, 0), 6) AS zscore FROM customer WINDOW p AS (PARTITION BY c_mktsegment)""")
def zscore(t):
    return service.zscore(t.customer, ["c_mktsegment"], "c_acctbal").select("c_custkey", r6("zscore").alias("zscore"))


@query("zscore_latest", covers="P69 F16", sql="""WITH l AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, max(value) AS v FROM events GROUP BY 1, 2, 3), m AS (SELECT * FROM l WHERE day = (SELECT max(day) FROM l))
SELECT user_id, event_type, day, round((v - avg(v) OVER p) / nullif(stddev_samp(v) OVER p, 0), 6) AS zscore FROM m WINDOW p AS (PARTITION BY event_type)""")
def zscore_latest(t):
    l = t.events.groupBy("user_id", "event_type", i.day("ts").alias("day")).agg(F.max("value").alias("v"))
    return service.zscore(l, ["event_type"], "v", "day").select("user_id", "event_type", "day", r6("zscore").alias("zscore"))


@query("top_issues_by_value", covers="P72 O05", sql="""WITH r AS (SELECT DISTINCT conv_id AS customer_id, unnest(regexp_extract_all(text, '[A-Z][a-z]{4,}')) AS reference FROM conversations), v AS (SELECT o_custkey AS customer_id, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1)
SELECT reference, round(sum(value), 2) AS total_value, count(*) AS customers FROM r JOIN v USING (customer_id) GROUP BY 1 ORDER BY round(sum(value), 2) DESC, reference LIMIT 25""")
def top_issues_by_value(t):
    tags = t.conversations.withColumnRenamed("conv_id", "customer_id")
    v = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(r2(F.sum("o_totalprice")).alias("value"))
    return service.top_issues_by_value(tags, "text", "[A-Z][a-z]{4,}", "customer_id", v, "value", 25).withColumn("total_value", r2("total_value"))


@query("run_stats", covers="P96 O04 M02", sql="""WITH l AS (SELECT * FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY event_type, user_id % 10 ORDER BY ts DESC, event_id DESC) <= 30)
SELECT event_type, user_id % 10 AS worker, count(*) AS occurrences, min(value) AS min_value, max(value) AS max_value FROM l GROUP BY 1, 2""")
def run_stats(t):
    e = t.events.withColumn("worker", F.col("user_id") % 10)
    return service.run_stats(e, ["event_type", "worker"], F.col("event_type") != "error", [F.col("ts").desc(), F.col("event_id").desc()], "value", 30)


@query("histogram_mode", covers="P95 M01", sql="""WITH l AS (SELECT l_suppkey, l_extendedprice AS x FROM lineitem WHERE l_quantity > 0 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_extendedprice) <= 200),
s AS (SELECT l_suppkey, count(*) AS n, min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM l GROUP BY 1),
b AS (SELECT *, CASE WHEN hi > lo THEN greatest(ceil(log2(n) + 1), CASE WHEN iqr > 0 THEN ceil((hi - lo) / (2 * iqr / pow(n, 1.0 / 3))) ELSE 0 END) ELSE 1 END AS bins FROM s),
c AS (SELECT l_suppkey, n, lo, hi, bins, CASE WHEN hi > lo THEN least(floor((x - lo) / ((hi - lo) / bins)), bins - 1) ELSE 0 END AS bin, count(*) AS c FROM l JOIN b USING (l_suppkey) GROUP BY ALL)
SELECT l_suppkey, n AS occurrences, lo AS min_value, hi AS max_value, round(lo + (bin + 0.5) * (hi - lo) / bins, 6) AS mode_value FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, bin) = 1""")
def histogram_mode(t):
    order = [F.col("l_shipdate").desc(), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]]
    stats = service.run_stats(t.lineitem, ["l_suppkey"], F.col("l_quantity") > 0, order, "l_extendedprice", 200, with_mode=True)
    return stats.withColumn("mode_value", F.round("mode_value", 6))


# --- quality ------------------------------------------------------------------------------------

@query("rule_results", covers="P81 J04", sql="""WITH d AS (SELECT CAST(unnest(generate_series((SELECT CAST(least(min(o_orderdate), (SELECT min(l_shipdate) FROM lineitem)) AS DATE) FROM orders), (SELECT CAST(greatest(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem)) AS DATE) FROM orders), INTERVAL 1 DAY)) AS DATE) AS run_date), o AS (SELECT CAST(o_orderdate AS DATE) AS run_date, 'positive price' AS rule, o_totalprice > 5000 AS ok FROM orders UNION ALL SELECT CAST(o_orderdate AS DATE), 'known status', o_orderstatus IN ('F', 'O') FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE), 'small discount', l_discount < 0.09 FROM lineitem),
g AS (SELECT run_date, rule, count(*) AS processed, count(*) FILTER (ok) AS passed FROM o GROUP BY 1, 2), x AS (SELECT run_date, rule FROM d CROSS JOIN (SELECT DISTINCT rule FROM o))
SELECT run_date, rule, coalesce(processed, 0) AS processed, coalesce(passed, 0) AS passed, coalesce(processed, 0) - coalesce(passed, 0) AS failed FROM g RIGHT JOIN x USING (run_date, rule)""")
def rule_results(t):
    dates = t.orders.select(F.to_date("o_orderdate").alias("d")).unionByName(t.lineitem.select(F.to_date("l_shipdate").alias("d")))
    first, last = dates.agg(F.min("d"), F.max("d")).first()
    days = calendar.date_spine(t.spark, first, last + dt.timedelta(days=1), "day", "run_date")
    return quality.rule_results({
        "positive price": (t.orders, "o_orderdate", F.col("o_totalprice") > 5000), "known status": (t.orders, "o_orderdate", F.col("o_orderstatus").isin("F", "O")),
        "small discount": (t.lineitem, "l_shipdate", F.col("l_discount") < 0.09)}, days)


@query("new_updated_counts", covers="P82 T16", sql="""WITH x AS (SELECT CAST(o_orderdate AS DATE) AS c, CAST(max(l_shipdate) AS DATE) AS u FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate), a AS (SELECT c AS day, count(*) AS n FROM x GROUP BY 1), b AS (SELECT u AS day, count(*) AS n FROM x GROUP BY 1)
SELECT coalesce(a.day, b.day) AS day, coalesce(a.n, 0) AS new_rows, coalesce(b.n, 0) AS updated_rows FROM a FULL JOIN b ON a.day = b.day""")
def new_updated_counts(t):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("u"))
    return quality.new_updated_counts(t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey")), "o_orderdate", "u")


@query("counts_by_date", covers="T16 M05", sql="SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1")
def counts_by_date(t):
    return quality.counts_by_date(t.events, "ts")


@query("check_constraints", covers="P83", sql="""SELECT 'key set' AS constraint, count(*) FILTER (l_orderkey IS NULL) AS failures, 'error' AS severity, CASE WHEN count(*) FILTER (l_orderkey IS NULL) = 0 THEN 'pass' ELSE 'error' END AS status FROM lineitem
UNION ALL SELECT 'line unique', count(*), 'warn', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'flag known', count(*) FILTER (l_returnflag NOT IN ('A', 'N')), 'error', CASE WHEN count(*) FILTER (l_returnflag NOT IN ('A', 'N')) = 0 THEN 'pass' ELSE 'error' END FROM lineitem
UNION ALL SELECT 'discount range', count(*) FILTER (l_discount < 0 OR l_discount > 0.08), 'warn', CASE WHEN count(*) FILTER (l_discount < 0 OR l_discount > 0.08) = 0 THEN 'pass' ELSE 'warn' END FROM lineitem
UNION ALL SELECT 'price above quantity', count(*) FILTER (NOT l_extendedprice > l_quantity), 'error', CASE WHEN count(*) FILTER (NOT l_extendedprice > l_quantity) = 0 THEN 'pass' ELSE 'error' END FROM lineitem
UNION ALL SELECT 'some tax', CASE WHEN count(l_tax) = 0 THEN 1 ELSE 0 END, 'error', 'pass' FROM lineitem
UNION ALL SELECT 'part exists', count(*), 'error', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) AND l_quantity > 40""")
def check_constraints(t):
    return quality.check(t.lineitem, [
        {"name": "key set", "kind": "not_null", "column": "l_orderkey"},
        {"name": "line unique", "kind": "unique_combination", "columns": ["l_orderkey", "l_linenumber"], "severity": "warn"},
        {"name": "flag known", "kind": "accepted_values", "column": "l_returnflag", "values": ["A", "N"]},
        {"name": "discount range", "kind": "accepted_range", "column": "l_discount", "min": 0, "max": 0.08, "severity": "warn"},
        {"name": "price above quantity", "kind": "expression_is_true", "expression": F.col("l_extendedprice") > F.col("l_quantity")},
        {"name": "some tax", "kind": "at_least_one", "column": "l_tax"},
        {"name": "part exists", "kind": "relationships", "column": "l_partkey", "to": t.part.where(F.col("p_size") > 10), "field": "p_partkey", "where": F.col("l_quantity") > 40}])


@query("freshness", covers="P84", sql="""SELECT max(ts) AS max_loaded_at, date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') - CASE WHEN date_trunc('second', max(ts)) <> max(ts) THEN 1 ELSE 0 END AS age_seconds, CASE WHEN TIMESTAMP '2024-01-31 12:00:00' - max(ts) > INTERVAL 48 HOUR THEN 'error' WHEN TIMESTAMP '2024-01-31 12:00:00' - max(ts) > INTERVAL 12 HOUR THEN 'warn' ELSE 'pass' END AS status FROM events""")
def freshness(t):
    return quality.freshness(t.events, "ts", dt.timedelta(hours=12), dt.timedelta(hours=48), dt.datetime(2024, 1, 31, 12))


@query("dynamic_pivot", covers="P91 A25", sql="""SELECT user_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS signup, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click,
 CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error FROM events GROUP BY 1""")
def dynamic_pivot(t):
    return quality.dynamic_pivot(t.events, ["user_id"], "event_type", F.lit(1).cast("long"), 50)


@query("melt_parts", covers="P92 A28", sql="""SELECT p_partkey, 'p_brand' AS field_name, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'p_name', p_name FROM part""")
def melt_parts(t):
    return quality.melt(t.part, ["p_partkey"], ["p_retailprice"])


@query("union_relations", covers="U03 U04 F04", sql="""SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS s_acctbal, 'customer' AS source_relation FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def union_relations(t):
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    sup = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), *quality.star(t.supplier, ["s_suppkey", "s_name", "s_nationkey"]))
    return quality.union_relations({"customer": c, "supplier": sup})
