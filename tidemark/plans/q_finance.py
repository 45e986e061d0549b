"""Cost allocation, receivables and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.operators import finance
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

r2 = lambda x: F.round(x, 2)
r4 = lambda x: F.round(x, 4)
r6 = lambda x: F.round(x, 6)


@query("allocation_ratio", covers="P51 W14 W17", sql="""WITH g AS (SELECT CAST(o_orderdate AS DATE) AS day, c_nationkey, sum(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT day, c_nationkey, round(total, 2) AS total, round(total / nullif(sum(total) OVER (PARTITION BY day), 0), 6) AS share FROM g""")
def allocation_ratio(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(i.day("o_orderdate").alias("day"), "c_nationkey", "o_totalprice")
    return finance.allocation_ratio(j, ["day"], ["c_nationkey"], "o_totalprice").withColumns({"total": r2("total"), "share": r6("share")})


@query("mapping_by_priority", covers="P52 J22 W03", sql="""WITH f AS (SELECT p_brand AS brand, p_type AS kind, p_size % 5 AS grade, round(sum(l_extendedprice), 2) AS cost, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
m AS (SELECT DISTINCT p_brand AS brand, p_type AS kind, CAST(NULL AS INTEGER) AS grade, 0.25 AS pct, 'brand-kind' AS label FROM part WHERE p_brand < 'Brand#2' UNION ALL SELECT DISTINCT p_brand, p_type, NULL, 0.75, 'brand-kind rest' FROM part WHERE p_brand < 'Brand#2'
 UNION ALL SELECT DISTINCT p_brand, NULL, NULL, 1.0, 'brand' FROM part WHERE p_brand < 'Brand#5' UNION ALL SELECT DISTINCT NULL, p_type, p_size % 5, 1.0, 'kind-grade' FROM part WHERE p_size % 5 < 2),
x AS (SELECT f.*, m.pct, m.label, CASE WHEN m.label IS NOT NULL THEN dense_rank() OVER (PARTITION BY f.brand, f.kind, f.grade ORDER BY CASE WHEN m.brand IS NOT NULL THEN 1 ELSE 0 END DESC, CASE WHEN m.kind IS NOT NULL THEN 1 ELSE 0 END DESC) ELSE 1 END AS r
 FROM f LEFT JOIN m ON (m.brand IS NULL OR m.brand = f.brand) AND (m.kind IS NULL OR m.kind = f.kind) AND (m.grade IS NULL OR m.grade = f.grade))
SELECT brand, kind, grade, lines, label, round(cost * coalesce(pct, 1), 4) AS cost FROM x WHERE r = 1""")
def mapping_by_priority(t):
    f = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), (F.col("p_size") % 5).alias("grade")).agg(r2(F.sum("l_extendedprice")).alias("cost"), F.count("*").alias("lines"))
    p = t.part.select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), (F.col("p_size") % 5).alias("grade"))
    none = lambda k: F.lit(None).cast(k)
    bk = p.where(F.col("brand") < "Brand#2").select("brand", "kind", none("int").alias("grade")).distinct()
    m = bk.select("*", F.lit(.25).alias("pct"), F.lit("brand-kind").alias("label")).unionByName(bk.select("*", F.lit(.75).alias("pct"), F.lit("brand-kind rest").alias("label")))
    m = m.unionByName(p.where(F.col("brand") < "Brand#5").select("brand", none("string").alias("kind"), none("int").alias("grade")).distinct().select("*", F.lit(1.0).alias("pct"), F.lit("brand").alias("label")))
    m = m.unionByName(p.where(F.col("grade") < 2).select(none("string").alias("brand"), "kind", "grade").distinct().select("*", F.lit(1.0).alias("pct"), F.lit("kind-grade").alias("label")))
    out = finance.apply_mapping_by_priority(f, m, [["brand", "kind"], ["brand"], ["kind", "grade"]], ["brand", "kind", "grade"], "pct", ["cost"], ["label"])
    return out.withColumn("cost", r4("cost"))


SQL_METERS = """iv AS (SELECT event_id, user_id % 8 AS wh, ts AS a, ts + to_minutes(CAST(event_id % 180 + 1 AS INTEGER)) AS b FROM events),
mt AS (SELECT wh, unnest(generate_series((SELECT date_trunc('hour', min(a)) FROM iv), (SELECT max(b) FROM iv), INTERVAL 1 HOUR)) AS ms FROM (SELECT DISTINCT user_id % 8 AS wh FROM events)),
meters AS (SELECT wh, ms, ms + INTERVAL 1 HOUR AS me, 1.0 + wh + hour(ms) AS credits FROM mt)"""


@query("overlap_attribution", covers="P53 J13", sql=f"""WITH {SQL_METERS}, j AS (SELECT iv.wh, event_id, ms AS meter_start, credits, CASE WHEN a >= ms AND b > me THEN date_diff('microsecond', a, me) // 1000 WHEN a < ms AND b > me THEN 3600000
 WHEN a < ms AND b <= me THEN date_diff('microsecond', ms, b) // 1000 WHEN a > ms AND b < me THEN date_diff('microsecond', a, b) // 1000 END AS overlap_ms FROM iv JOIN meters m ON iv.wh = m.wh AND NOT (me <= a OR ms >= b))
SELECT wh, event_id, meter_start, overlap_ms, round(overlap_ms / nullif(sum(overlap_ms) OVER (PARTITION BY wh, meter_start), 0), 6) AS fraction, round(overlap_ms / nullif(sum(overlap_ms) OVER (PARTITION BY wh, meter_start), 0) * credits, 6) AS attributed FROM j""")
def overlap_attribution(t):
    wh = (F.col("user_id") % 8).alias("wh")
    iv = t.events.select("event_id", wh, F.col("ts").alias("start"), F.timestamp_add("MINUTE", (F.col("event_id") % 180 + 1).cast("int"), F.col("ts")).alias("end"))
    span = iv.agg(F.date_trunc("hour", F.min("start")).cast("timestamp_ntz").alias("a"), F.max("end").cast("timestamp_ntz").alias("b"))
    hours = F.sequence(span.select("a").scalar(), span.select("b").scalar(), F.expr("INTERVAL 1 HOUR"))
    m = t.events.select(wh).distinct().select("wh", F.explode(hours).alias("start"))
    m = m.select("wh", "start", F.timestamp_add("HOUR", F.lit(1), F.col("start")).alias("end"), (1.0 + F.col("wh") + F.hour("start")).alias("credits"))
    out = finance.overlap_attribution(iv, m, "wh", "event_id", "credits")
    return out.withColumns({"fraction": r6("fraction"), "attributed": r6("attributed")})


@query("unpivot_allocation", covers="P54 A27 A25", sql="""WITH g AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1)
SELECT month, 'A' AS flag, round(a / n, 6) AS share FROM g UNION ALL SELECT month, 'N', round(b / n, 6) FROM g UNION ALL SELECT month, 'R', round(c / n, 6) FROM g""")
def unpivot_allocation(t):
    wide = t.lineitem.groupBy(i.month("l_shipdate").alias("month")).pivot("l_returnflag", ["A", "N", "R"]).count().na.fill(0)
    n = F.col("A") + F.col("N") + F.col("R")
    shares = wide.select("month", *[r6(F.col(x) / n).alias(x) for x in "ANR"])
    return finance.unpivot_allocation(shares, ["month"], ["A", "N", "R"], "flag", "share")


@query("aging_buckets", covers="P55 M05", sql=f"""WITH {i.SQL_INVOICES}, x AS (SELECT invoice_id, CAST(date_trunc('month', invoice_date) AS DATE) AS period, balance, amount, date_diff('day', invoice_date, due_date) AS payment_terms, date_diff('day', due_date, DATE '2001-12-31') AS days_overdue FROM invoices WHERE balance > 0)
SELECT *, CASE WHEN days_overdue <= 0 THEN '1 -- Current' WHEN days_overdue <= 30 THEN '2 -- 1 to 30 days past due' WHEN days_overdue <= 60 THEN '3 -- 31 to 60 days past due' WHEN days_overdue <= 90 THEN '4 -- 61 to 90 days past due' WHEN days_overdue <= 120 THEN '5 -- 91 to 120 days past due' ELSE '6 -- More than 120 days past due' END AS aging_bucket FROM x""")
def aging_buckets(t):
    return finance.aging_buckets(i.invoices(t), i.ORDERS_AS_OF)


@query("days_buckets", covers="M05", sql=f"""WITH {i.SQL_INVOICES}, x AS (SELECT date_diff('day', invoice_date, payment_date) AS d FROM payments)
SELECT CASE WHEN d <= 7 THEN '[0-7]' WHEN d <= 14 THEN '[8-14]' WHEN d <= 30 THEN '[15-30]' ELSE '[30+]' END AS bucket, count(*) AS payments FROM x GROUP BY 1""")
def days_buckets(t):
    d = F.datediff("payment_date", "invoice_date")
    return i.payments(t).groupBy(finance.days_bucket(d, [7, 14, 30]).alias("bucket")).agg(F.count("*").alias("payments"))


def rollforward(t):
    inv, pay = i.invoices(t), i.payments(t)
    per = lambda d, c, x: d.groupBy(F.trunc(c, "month").alias("period")).agg(F.sum(x).alias("amount"))
    aged = finance.aging_buckets(inv, i.ORDERS_AS_OF)
    amt = F.col("amount")
    feeds = {
        "billing": per(inv, "invoice_date", "amount"), "payments": per(pay, "payment_date", -amt),
        "refunds": per(pay.where(F.col("invoice_id") % 50 == 0), "payment_date", amt), "adjustments": per(inv.where(F.col("invoice_id") % 40 == 0), "due_date", -amt * 0.5),
        "current": per(aged.where(F.col("days_overdue") <= 400), "period", "balance"), "aged": per(aged, "period", "balance"),
    }
    return finance.balance_rollforward(feeds, ["billing", "payments", "refunds", "adjustments"], "billing", "aged")


SQL_ROLL = f"""{i.SQL_INVOICES}, fb AS (SELECT date_trunc('month', invoice_date) AS p, sum(amount) AS billing FROM invoices GROUP BY 1), fp AS (SELECT date_trunc('month', payment_date) AS p, -sum(amount) AS payments FROM payments GROUP BY 1),
fr AS (SELECT date_trunc('month', payment_date) AS p, sum(amount) AS refunds FROM payments WHERE invoice_id % 50 = 0 GROUP BY 1), fa AS (SELECT date_trunc('month', due_date) AS p, -sum(amount) * 0.5 AS adjustments FROM invoices WHERE invoice_id % 40 = 0 GROUP BY 1),
fc AS (SELECT date_trunc('month', invoice_date) AS p, sum(balance) AS current FROM invoices WHERE balance > 0 AND date_diff('day', due_date, DATE '2001-12-31') <= 400 GROUP BY 1), fg AS (SELECT date_trunc('month', invoice_date) AS p, sum(balance) AS aged FROM invoices WHERE balance > 0 GROUP BY 1),
tb AS (SELECT fb.p, coalesce(billing, 0) AS billing, coalesce(payments, 0) AS payments, coalesce(refunds, 0) AS refunds, coalesce(adjustments, 0) AS adjustments, coalesce(current, 0) AS current, coalesce(aged, 0) AS aged
 FROM fb FULL JOIN fp ON fb.p = fp.p FULL JOIN fr ON fb.p = fr.p FULL JOIN fa ON fb.p = fa.p FULL JOIN fc ON fb.p = fc.p FULL JOIN fg ON fb.p = fg.p WHERE billing > 0),
en AS (SELECT *, sum(billing + payments + refunds + adjustments) OVER (ORDER BY p) AS ending_balance FROM tb),
roll AS (SELECT CAST(p AS DATE) AS period, billing, payments, refunds, adjustments, current, aged, ending_balance, coalesce(lag(ending_balance) OVER (ORDER BY p), 0) AS starting_balance, coalesce(lag(aged) OVER (ORDER BY p), 0) AS starting_aged FROM en)"""
ROLL_COLS = ["billing", "payments", "refunds", "adjustments", "current", "aged", "ending_balance", "starting_balance", "starting_aged"]


@query("balance_rollforward", covers="P57", sql=f"""WITH {SQL_ROLL} SELECT period, {', '.join(f'round({c}, 3) AS {c}' for c in ROLL_COLS)} FROM roll""")
def balance_rollforward(t):
    return rollforward(t).select("period", *[F.round(c, 3).alias(c) for c in ROLL_COLS])


@query("dso_cei", covers="P56", sql=f"""WITH {SQL_ROLL} SELECT period, round((starting_aged + aged) / 2 / billing * 30, 0) AS dso, round((starting_aged + billing - aged) / nullif(starting_aged + billing - current, 0) * 100, 2) AS cei FROM roll""")
def dso_cei(t):
    return finance.dso_cei(rollforward(t))


@query("cumulative_balance_fx", covers="P58 J15", sql="""WITH l AS (SELECT o_orderstatus AS ledger, CASE WHEN l_returnflag = 'R' THEN 'equity' ELSE l_returnflag END AS kind, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_extendedprice) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
s AS (SELECT ledger, kind, CAST(unnest(generate_series(a, (SELECT max(period) FROM l), INTERVAL 1 MONTH)) AS DATE) AS period FROM (SELECT ledger, kind, min(period) AS a FROM l GROUP BY 1, 2)),
d AS (SELECT s.*, coalesce(amount, 0) AS amount, 1 + month(s.period) / 100 AS ar, 2 - month(s.period) / 50 AS cr FROM s LEFT JOIN l USING (ledger, kind, period))
SELECT ledger, kind, period, round(sum(amount) OVER w, 2) AS balance, round(sum(amount * ar) OVER w, 4) AS balance_at_average, round(sum(amount) OVER w * cr, 4) AS balance_at_closing FROM d WINDOW w AS (PARTITION BY ledger, kind ORDER BY period)""")
def cumulative_balance_fx(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderstatus").alias("ledger"), F.col("l_returnflag").alias("kind"), i.month("l_shipdate").alias("period"), F.col("l_extendedprice").alias("amount"))
    rates = lines.select("period").distinct().select("period", (1 + F.month("period") / 100).alias("average_rate"), (2 - F.month("period") / 50).alias("closing_rate"))
    out = finance.cumulative_balance_fx(lines, ["ledger"], "period", "amount", rates, "kind", "R", "equity")
    return out.select("ledger", "kind", "period", r2("balance").alias("balance"), r4("balance_at_average").alias("balance_at_average"), r4("balance_at_closing").alias("balance_at_closing"))


@query("payment_ledger", covers="P59", sql=f"""WITH {i.SQL_INVOICES}, g AS (SELECT CAST(date_trunc('month', payment_date) AS DATE) AS period, payment_type, sum(amount) AS total FROM payments GROUP BY 1, 2)
SELECT period, payment_type, round(total, 2) AS total, round(total / nullif(sum(total) OVER (PARTITION BY period), 0), 6) AS share FROM g""")
def payment_ledger(t):
    p = i.payments(t).withColumn("period", F.trunc("payment_date", "month"))
    return finance.monthly_ledger(p, "period", "payment_type", "amount").withColumns({"total": r2("total"), "share": r6("share")})


@query("collections_matrix", covers="P59", sql=f"""WITH {i.SQL_INVOICES} SELECT CAST(date_trunc('month', payment_date) AS DATE) AS payment_month, CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month, round(sum(amount), 2) AS collected, count(*) AS payments,
 CAST(date_diff('month', date_trunc('month', invoice_date), date_trunc('month', payment_date)) AS INTEGER) AS months_to_pay FROM payments GROUP BY ALL""")
def collections_matrix(t):
    return finance.collections_matrix(i.payments(t)).withColumn("collected", r2("collected"))


@query("potential_bad_debt", covers="P59 P55", sql=f"""WITH {i.SQL_INVOICES} SELECT account_id, count(*) AS invoices, round(sum(balance), 2) AS pending, max(date_diff('day', due_date, DATE '2001-12-31')) AS oldest_days FROM invoices WHERE balance > 0 AND date_diff('day', due_date, DATE '2001-12-31') > 90 GROUP BY 1""")
def potential_bad_debt(t):
    a = finance.aging_buckets(i.invoices(t), i.ORDERS_AS_OF).where(F.col("days_overdue") > 90)
    a = a.join(i.invoices(t).select("invoice_id", "account_id"), "invoice_id")
    return a.groupBy("account_id").agg(F.count("*").alias("invoices"), r2(F.sum("balance")).alias("pending"), F.max("days_overdue").alias("oldest_days"))


@query("discount_analysis", covers="P107", sql="""WITH x AS (SELECT *, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS pq FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(p_retailprice, 2) AS list_price, l_extendedprice * (1 - l_discount) / l_quantity AS realised_price, l_quantity - coalesce(pq, 0) AS delta_quantity FROM x JOIN part ON l_partkey = p_partkey""")
def discount_analysis(t):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    items = t.lineitem.select("l_orderkey", *order, "l_quantity", "l_discount").join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    d = finance.discount_analysis(items, "l_orderkey", order, None, F.round("p_retailprice", 2), price, "l_quantity", F.lit(30))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "list_price", "realised_price", "delta_quantity")


@query("effective_days", covers="P107", sql="""WITH x AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate + to_months(CAST(o_orderkey % 30 AS INTEGER)) AS DATE) AS b FROM orders)
SELECT o_orderkey, date_diff('day', a, b) - CASE WHEN DATE '1996-02-29' BETWEEN a AND b OR DATE '2000-02-29' BETWEEN a AND b OR DATE '2004-02-29' BETWEEN a AND b THEN 1 ELSE 0 END AS days FROM x""")
def effective_days(t):
    a = i.day("o_orderdate")
    b = F.add_months(a, (F.col("o_orderkey") % 30).cast("int"))
    return t.orders.select("o_orderkey", a.alias("a"), b.alias("b")).select("o_orderkey", finance.effective_days(F.col("a"), F.col("b")).alias("days"))


@query("three_way_reconcile", covers="P115 J03", sql="""WITH a AS (SELECT c_custkey AS key FROM customer WHERE c_custkey % 2 = 0), b AS (SELECT o_custkey AS key, count(*) AS orders FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1), c AS (SELECT user_id AS key, count(*) AS events FROM events GROUP BY 1),
j AS (SELECT coalesce(a.key, b.key, c.key) AS key, orders, events, a.key IS NOT NULL AS ia, b.key IS NOT NULL AS ib, c.key IS NOT NULL AS ic FROM a FULL JOIN b ON a.key = b.key FULL JOIN c ON coalesce(a.key, b.key) = c.key)
SELECT key, orders, events, CASE WHEN ia AND ib AND ic THEN 'all three' WHEN ia AND ib THEN 'a and b' WHEN ia AND ic THEN 'a and c' WHEN ib AND ic THEN 'b and c' WHEN ia THEN 'a only' WHEN ib THEN 'b only' ELSE 'c only' END AS match_status FROM j""")
def three_way_reconcile(t):
    a = t.customer.where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("key"))
    b = t.orders.where(F.col("o_custkey") % 3 == 0).groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("orders"))
    c = t.events.groupBy(F.col("user_id").alias("key")).agg(F.count("*").alias("events"))
    return finance.three_way_reconcile(a, b, c, "key")


@query("coalesce_sources", covers="P108", sql="""WITH a AS (SELECT c_custkey % 100 AS id, max(c_acctbal) AS v FROM customer WHERE c_custkey % 100 < 30 GROUP BY 1), b AS (SELECT o_custkey % 100 AS id, max(o_totalprice) AS v FROM orders WHERE o_custkey % 100 < 60 GROUP BY 1), c AS (SELECT user_id % 100 AS id, max(value) AS v FROM events GROUP BY 1),
k AS (SELECT id FROM a UNION SELECT id FROM b UNION SELECT id FROM c)
SELECT k.id, CASE WHEN a.v IS NOT NULL THEN 'billing' WHEN b.v IS NOT NULL THEN 'orders' ELSE 'usage' END AS source, coalesce(a.v, b.v, c.v) AS v FROM k LEFT JOIN a ON k.id = a.id LEFT JOIN b ON k.id = b.id LEFT JOIN c ON k.id = c.id""")
def coalesce_sources(t):
    mk = lambda d, k, v, n: d.groupBy((F.col(k) % 100).alias("id")).agg(F.max(v).alias("v")).where(F.col("id") < n)
    return finance.coalesce_sources([("billing", mk(t.customer, "c_custkey", "c_acctbal", 30)), ("orders", mk(t.orders, "o_custkey", "o_totalprice", 60)),
                                     ("usage", mk(t.events, "user_id", "value", 100))], ["id"], "v")


@query("ip_to_region", covers="P60 J14 M05", sql="""WITH ips AS (SELECT event_id, (user_id % 30)::BIGINT * 16777216 + (event_id % 256) * 65536 + 77 AS n FROM events), r AS (SELECT CAST(n_nationkey AS BIGINT) * 16777216 AS a, CAST(n_nationkey AS BIGINT) * 16777216 + 16777215 - n_nationkey * 1000 AS b, n_name FROM nation)
SELECT n_name AS nation, count(*) AS events FROM ips JOIN r ON n BETWEEN a AND b GROUP BY 1""")
def ip_to_region(t):
    ip = F.concat_ws(".", (F.col("user_id") % 30).cast("string"), (F.col("event_id") % 256).cast("string"), F.lit("0"), F.lit("77"))
    ips = t.events.select("event_id", s.ip_number(ip).alias("n"))
    base = F.col("n_nationkey").cast("long") * 16777216
    r = t.nation.select(base.alias("a"), (base + 16777215 - F.col("n_nationkey") * 1000).alias("b"), F.col("n_name").alias("nation"))
    return finance.ip_to_region(ips, "n", r, "a", "b").groupBy("nation").agg(F.count("*").alias("events"))
