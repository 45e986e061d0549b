"""Keys, calendar and recurring revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import scalars as s
from tidemark.operators import calendar, keys, linking, ordered, revenue
from tidemark.plans import inputs as i
from tidemark.plans.registry import query
from tidemark.session import dealt

r2 = lambda x: F.round(x, 2)
r4 = lambda x: F.round(x, 4)

KIND_SQL = """CASE WHEN {n} > 0 AND {p} = 1 THEN 'New' WHEN {n} = 0 AND {b} > 0 THEN 'Churn'
  WHEN {n} < {b} AND {n} > 0 THEN 'Contraction' WHEN {n} > {b} AND {p} > 1 THEN 'Expansion' WHEN {n} = {b} THEN 'No Impact' END"""

SQL_MOVEMENT = f"""{i.SQL_ACCOUNT_MONTH}, {i.SQL_ACCOUNT_DENSE}, prior AS (
  SELECT *, coalesce(lag(amount) OVER w, 0) AS previous_amount, coalesce(lag(quantity) OVER w, 0) AS previous_quantity,
         coalesce(lag(tier) OVER w, 0) AS previous_tier, row_number() OVER w AS position
  FROM account_dense WINDOW w AS (PARTITION BY account_id ORDER BY month)),
moved AS (SELECT *, {KIND_SQL.format(n='amount', b='previous_amount', p='position')} AS change_type FROM prior)"""


def moved(t):
    return revenue.movement(i.account_month(t), "account_id", "month", "amount", ["quantity", "tier"])


@query("movement_monthly", covers="P31 P20 P17 W05 J01 A06", sql=f"""WITH {SQL_MOVEMENT}
SELECT md5(concat_ws('-', CAST(account_id AS VARCHAR), CAST(month AS VARCHAR))) AS movement_id, account_id, month,
  amount, previous_amount, change_type, round(amount - previous_amount, 2) AS delta FROM moved""")
def movement_monthly(t):
    return moved(t).select(
        s.surrogate_key(["account_id", "month"]).alias("movement_id"), "account_id", "month", "amount",
        "previous_amount", "change_type", r2("delta").alias("delta"))


@query("movement_summary", covers="P31 A01", sql=f"""WITH {SQL_MOVEMENT}
SELECT month, change_type, count(*) AS accounts, round(sum(amount - previous_amount), 2) AS delta FROM moved GROUP BY 1, 2""")
def movement_summary(t):
    return moved(t).groupBy("month", "change_type").agg(F.count("*").alias("accounts"), r2(F.sum("delta")).alias("delta"))


@query("decompose_delta", covers="P32", sql=f"""WITH {SQL_MOVEMENT}, steps AS (
  SELECT *, amount / nullif(quantity, 0) - previous_amount / nullif(previous_quantity, 0) AS step FROM moved)
SELECT account_id, month, change_type,
  CASE WHEN change_type IN ('Expansion','Contraction') AND previous_quantity <> quantity AND previous_quantity > 0
        THEN coalesce(previous_amount / previous_quantity * (quantity - previous_quantity), 0)
        WHEN previous_quantity <> quantity AND previous_quantity = 0 THEN amount ELSE 0 END AS seat_change,
  CASE WHEN previous_tier = tier THEN quantity * step ELSE 0 END AS price_change,
  CASE WHEN previous_tier <> tier THEN coalesce(quantity * step, 0) ELSE 0 END AS tier_change,
  CASE WHEN previous_tier < tier THEN coalesce(quantity * step, 0) ELSE 0 END AS uptier_change,
  CASE WHEN previous_tier > tier THEN coalesce(quantity * step, 0) ELSE 0 END AS downtier_change,
  step AS price_per_seat_change FROM steps""")
def decompose_delta(t):
    parts = ["seat_change", "price_change", "tier_change", "uptier_change", "downtier_change", "price_per_seat_change"]
    return revenue.decompose_delta(moved(t)).select("account_id", "month", "change_type", *parts)


@query("retention_yearly", covers="P33 J16", sql=f"""WITH {i.SQL_ACCOUNT_MONTH}, pair AS (
  SELECT a.account_id, CAST(a.month + INTERVAL 12 MONTH AS DATE) AS retention_month, a.amount AS prior_amount, coalesce(b.amount, 0) AS net_retention
  FROM account_month a LEFT JOIN account_month b ON a.account_id = b.account_id AND b.month = CAST(a.month + INTERVAL 12 MONTH AS DATE))
SELECT *, CASE WHEN net_retention > 0 THEN least(net_retention, prior_amount) ELSE 0 END AS gross_retention,
  {KIND_SQL.format(n='net_retention', b='prior_amount', p='2')} AS retention_type FROM pair""")
def retention_yearly(t):
    return revenue.retention(i.account_month(t), ["account_id"], "month", "amount")


@query("retention_summary", covers="P33", sql=f"""WITH {i.SQL_ACCOUNT_MONTH}, pair AS (
  SELECT a.account_id, CAST(a.month + INTERVAL 12 MONTH AS DATE) AS retention_month, a.amount AS prior_amount, coalesce(b.amount, 0) AS net
  FROM account_month a LEFT JOIN account_month b ON a.account_id = b.account_id AND b.month = CAST(a.month + INTERVAL 12 MONTH AS DATE))
SELECT retention_month, round(sum(net) / sum(prior_amount), 6) AS net_rate,
  round(sum(CASE WHEN net > 0 THEN least(net, prior_amount) ELSE 0 END) / sum(prior_amount), 6) AS gross_rate FROM pair GROUP BY 1""")
def retention_summary(t):
    r = revenue.retention(i.account_month(t), ["account_id"], "month", "amount")
    return r.groupBy("retention_month").agg(
        F.round(s.ratio(F.sum("net_retention"), F.sum("prior_amount")), 6).alias("net_rate"),
        F.round(s.ratio(F.sum("gross_retention"), F.sum("prior_amount")), 6).alias("gross_rate"))


def _between_sql(months):
    return f"""WITH {i.SQL_ACCOUNT_MONTH}, pair AS (
  SELECT coalesce(a.account_id, b.account_id) AS account_id, coalesce(a.month, b.month) AS month, a.amount AS p0,
    coalesce(a.amount, 0) AS prior_amount, coalesce(b.amount, 0) AS current_amount
  FROM (SELECT account_id, CAST(month + INTERVAL {months} MONTH AS DATE) AS month, amount FROM account_month) a
  FULL JOIN account_month b ON a.account_id = b.account_id AND a.month = b.month)
SELECT account_id, month, prior_amount, current_amount,
  CASE WHEN prior_amount > 100000 THEN '1. > 100K' WHEN prior_amount > 5000 THEN '2. 5K-100K' ELSE '3. <= 5K' END AS prior_band,
  CASE WHEN current_amount > 100000 THEN '1. > 100K' WHEN current_amount > 5000 THEN '2. 5K-100K' ELSE '3. <= 5K' END AS current_band,
  CASE WHEN p0 IS NULL THEN 'New' WHEN current_amount = 0 AND abs(prior_amount) > 0 THEN 'Churn'
    WHEN current_amount < prior_amount AND current_amount > 0 THEN 'Contraction' WHEN current_amount > prior_amount THEN 'Expansion'
    WHEN current_amount = prior_amount THEN 'No Impact' END AS change_type,
  CASE WHEN p0 IS NULL THEN current_amount ELSE 0 END AS new_amount,
  CASE WHEN current_amount = 0 AND prior_amount <> 0 THEN -prior_amount ELSE 0 END AS churn_amount,
  CASE WHEN current_amount > 0 THEN least(current_amount, prior_amount) ELSE 0 END AS gross_retention FROM pair"""


@query("movement_quarter_on_quarter", covers="P34 J03", sql=_between_sql(3))
def movement_quarter_on_quarter(t):
    return revenue.movement_between(i.account_month(t), ["account_id"], "month", "amount", 3)


@query("movement_year_on_year", covers="P34", sql=_between_sql(12))
def movement_year_on_year(t):
    return revenue.movement_between(i.account_month(t), ["account_id"], "month", "amount", 12)


@query("cohort_first_month", covers="P36", sql="""WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice,
  CAST(date_trunc('month', min(o_orderdate) OVER (PARTITION BY o_custkey)) AS DATE) AS cohort_month FROM orders)
SELECT cohort_month, date_diff('month', cohort_month, order_date) AS months_since, count(DISTINCT o_custkey) AS customers,
  round(sum(o_totalprice), 2) AS amount FROM d GROUP BY 1, 2""")
def cohort_first_month(t):
    o = t.orders.select("o_custkey", i.day("o_orderdate").alias("order_date"), "o_totalprice")
    c = revenue.cohort(o, "o_custkey", "order_date")
    return c.groupBy("cohort_month", s.boundary_diff("month", "cohort_month", "order_date").cast("long").alias("months_since")).agg(
        F.countDistinct("o_custkey").alias("customers"), r2(F.sum("o_totalprice")).alias("amount"))


@query("segment_accounts", covers="P38a W02", sql="""WITH c AS (SELECT o_custkey AS account_id, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1),
r AS (SELECT *, rank() OVER (ORDER BY amount DESC) AS amount_rank FROM c)
SELECT *, CASE WHEN amount_rank <= 10 THEN 'Top 10' WHEN amount_rank <= 100 THEN 'Top 100' ELSE 'Other' END AS rank_band,
  CASE WHEN amount >= 3000000 THEN '>= 3e+06' WHEN amount >= 1000000 THEN '>= 1e+06' ELSE '< 1e+06' END AS amount_band FROM r""")
def segment_accounts(t):
    c = t.orders.groupBy(F.col("o_custkey").alias("account_id")).agg(r2(F.sum("o_totalprice")).alias("amount"))
    return revenue.segment_by_amount_and_rank(c, "amount", [10, 100], [1e6, 3e6])


SQL_RENEW = """terms AS (
  SELECT o_custkey AS account_id, o_orderkey AS version, CAST(o_orderdate AS DATE) AS term_start,
    CAST(o_orderdate + to_months(CASE WHEN o_orderpriority < '3' THEN 12 ELSE 24 END) AS DATE) AS term_end,
    CASE WHEN o_orderstatus = 'P' THEN concat('R', CAST(o_custkey AS VARCHAR)) END AS ramp_id FROM orders),
m AS (SELECT *, date_trunc('month', term_start) AS sm, date_trunc('month', term_end) AS em, year(term_end) + CASE WHEN month(term_end) < 2 THEN 0 ELSE 1 END AS ey FROM terms),
dup AS (SELECT *, ramp_id IS NULL AND coalesce(lead(sm) OVER (PARTITION BY account_id ORDER BY ramp_id NULLS LAST, version) = sm, false) AS is_dup FROM m),
f AS (SELECT *, (coalesce(lead(em) OVER w = em, false) OR coalesce(lead(em, 2) OVER w = em, false) OR coalesce(lead(ey) OVER w = ey, false) OR coalesce(lead(sm) OVER w = sm, false)
   OR coalesce(min(sm) OVER (PARTITION BY account_id ORDER BY version ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) < sm, false)) AS gone
  FROM dup WHERE NOT is_dup WINDOW w AS (PARTITION BY account_id ORDER BY version)),
l AS (SELECT *, row_number() OVER (PARTITION BY account_id, term_end ORDER BY ramp_id NULLS LAST, version DESC) AS rn FROM f WHERE NOT gone),
b AS (SELECT * FROM l WHERE rn = 1),
ra AS (SELECT ramp_id, min(term_start) AS rs, max(term_end) AS re FROM b WHERE ramp_id IS NOT NULL GROUP BY 1),
renewals AS (SELECT account_id, version, term_start, term_end, b.ramp_id, coalesce(rs, term_start) AS renewal_term_start, coalesce(re, term_end) AS renewal_term_end
FROM b LEFT JOIN ra ON b.ramp_id = ra.ramp_id WHERE b.ramp_id IS NULL OR re = term_end)"""


def renewals(t):
    d = i.day("o_orderdate")
    terms = t.orders.select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("version"), d.alias("term_start"),
        F.add_months(d, F.when(F.col("o_orderpriority") < "3", 12).otherwise(24)).alias("term_end"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("R"), F.col("o_custkey").cast("string"))).alias("ramp_id"))
    return revenue.available_to_renew(terms, "account_id", "version")


@query("available_to_renew", covers="P37a W06", sql=f"WITH {SQL_RENEW} SELECT * FROM renewals")
def available_to_renew(t):
    return renewals(t)


@query("renewal_amounts", covers="P37a", sql=f"""WITH {SQL_RENEW}, c AS (SELECT l_orderkey AS version, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate + to_months(CASE WHEN l_linenumber % 2 = 0 THEN 12 ELSE 24 END) AS DATE) AS term_end, l_quantity AS quantity, l_extendedprice AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT account_id, renewals.version, renewals.term_end, sum(quantity) AS quantity, round(sum(amount), 2) AS amount FROM renewals JOIN c ON renewals.version = c.version AND renewals.term_end = c.term_end AND s <> c.term_end GROUP BY 1, 2, 3""")
def renewal_amounts(t):
    d = i.day("o_orderdate")
    c = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("version"), d.alias("charge_start"), F.add_months(d, F.when(F.col("l_linenumber") % 2 == 0, 12).otherwise(24)).alias("charge_end"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("amount"))
    return revenue.renewal_amounts(renewals(t), c, "version").select("account_id", "version", "term_end", "quantity", r2("amount").alias("amount"))


@query("retention_labels", covers="P33 M05 W02", sql=f"""WITH {i.SQL_ACCOUNT_MONTH}, p AS (SELECT a.account_id, CAST(a.month + INTERVAL 12 MONTH AS DATE) AS later_month, a.amount AS a0, a.quantity AS q0, a.tier AS t0, coalesce(b.amount, 0) AS a1, coalesce(b.quantity, 0) AS q1, b.tier AS t1
  FROM account_month a LEFT JOIN account_month b ON a.account_id = b.account_id AND b.month = CAST(a.month + INTERVAL 12 MONTH AS DATE)), s AS (SELECT *, a1 / nullif(q1, 0) - a0 / nullif(q0, 0) AS step FROM p)
SELECT account_id, later_month, CASE WHEN a1 = 0 AND a0 > 0 THEN 'Churn' WHEN a1 < a0 THEN 'Contraction' WHEN a1 > a0 THEN 'Expansion' ELSE 'No Impact' END AS retention_type,
 CASE WHEN a1 = 0 THEN 'Cancellation' WHEN a1 = a0 THEN 'No Change' WHEN t0 <> t1 AND q0 <> q1 THEN 'Product and Seat Change' WHEN t0 <> t1 THEN 'Product Change' WHEN q0 <> q1 AND abs(step) > 0.005 THEN 'Price and Seat Change' WHEN q0 <> q1 THEN 'Seat Change' ELSE 'Price Change' END AS retention_reason,
 CASE WHEN a1 = 0 THEN 'Cancelled' WHEN t1 > t0 THEN 'Upgraded' WHEN t1 < t0 THEN 'Downgraded' ELSE 'Maintained' END AS plan_change, CASE WHEN a1 = 0 THEN 'Cancelled' WHEN q1 > q0 THEN 'Expanded' WHEN q1 < q0 THEN 'Contracted' ELSE 'Maintained' END AS seat_change,
 CASE WHEN a1 = 0 THEN 'Full Churn' WHEN a1 < a0 THEN 'Partial Churn' END AS churn_type, CASE WHEN a1 > a0 THEN CASE WHEN t1 > t0 THEN 'Upsell' ELSE 'Seat or Price Growth' END END AS growth_type, step AS price_per_seat_change FROM s""")
def retention_labels(t):
    pair = revenue.shifted_pair(i.account_month(t), ["account_id"], "month", ["amount", "quantity", "tier"], 12, "left")
    return revenue.retention_labels(pair).drop(*[f"{a}_{m}" for a in ("then", "later") for m in ("amount", "quantity", "tier")])


@query("link_orders_to_items", covers="P39a J23", sql="""WITH li AS (SELECT l_orderkey, l_partkey, count(*) AS n, round(sum(l_extendedprice), 2) AS amount, max(CAST(l_shipdate AS DATE)) AS ship_date FROM lineitem GROUP BY 1, 2),
h AS (SELECT o_orderkey, l_partkey, amount, 1 AS link_pass, 'same day' AS link_rule FROM orders JOIN li ON o_orderkey = l_orderkey AND ship_date = CAST(o_orderdate AS DATE)
 UNION ALL SELECT o_orderkey, l_partkey, amount, 2, 'same month' FROM orders JOIN li ON o_orderkey = l_orderkey AND date_trunc('month', ship_date) = date_trunc('month', o_orderdate)
 UNION ALL SELECT o_orderkey, l_partkey, amount, 3, 'any item' FROM orders JOIN li ON o_orderkey = l_orderkey)
SELECT o_orderkey AS order_id, l_partkey AS part_id, amount, link_pass, link_rule FROM (
 SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY link_pass, amount DESC, l_partkey) AS rn FROM h) WHERE rn = 1""")
def link_orders_to_items(t):
    items = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(
        r2(F.sum("l_extendedprice")).alias("amount"), F.max(i.day("l_shipdate")).alias("ship_date"))
    o = t.orders.select("o_orderkey", i.day("o_orderdate").alias("order_date"))
    same = F.col("o_orderkey") == F.col("l_orderkey")
    linked = revenue.link_records(o, items, "o_orderkey", [
        ("same day", same & (F.col("ship_date") == F.col("order_date"))),
        ("same month", same & (F.trunc("ship_date", "month") == F.trunc("order_date", "month"))),
        ("any item", same)], [F.col("amount").desc(), F.col("l_partkey")])
    return linked.select(F.col("o_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), "amount", "link_pass", "link_rule")


SQL_LINKS = """inv AS (SELECT o_orderkey AS invoice_id, o_custkey AS customer, round(sum(l_extendedprice), 2) AS amount, CAST(sum(l_quantity) AS BIGINT) * 10 AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
opp AS (SELECT invoice_id + 7000000000 AS deal_id, customer, CASE WHEN invoice_id % 3 = 0 THEN round(amount / 1000) * 1000 ELSE amount END AS deal_amount,
 CASE WHEN invoice_id % 2 = 0 THEN 'Renewal, ' || format('{:,}', quantity - quantity % 50) || ' seats' WHEN invoice_id % 5 = 0 THEN 'Add-on ' || CAST(quantity AS VARCHAR) ELSE 'New deal' END AS deal_name FROM inv
 UNION ALL SELECT 9000000000 + min(invoice_id), customer, min(amount), 'Copy' FROM inv GROUP BY customer),
pair AS (SELECT invoice_id, deal_id, inv.customer, 5 * (round(amount, 2) = round(deal_amount, 2))::INT
  + 5 * list_contains(list_transform(regexp_extract_all(deal_name, '[0-9][0-9,]*'), lambda x: replace(x, ',', '')::BIGINT), quantity)::INT
  + (list_contains(list_transform(regexp_extract_all(deal_name, '[0-9][0-9,]*'), lambda x: replace(x, ',', '')::BIGINT), quantity) AND contains(deal_name, format('{:,}', quantity)))::INT AS points FROM inv JOIN opp USING (customer))"""


@query("link_one_to_one", covers="P39a J23", sql=f"""WITH RECURSIVE {SQL_LINKS},
line AS (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY points DESC, invoice_id, deal_id) AS k FROM pair WHERE points > 0),
walk AS (SELECT customer, 0::BIGINT AS k, []::BIGINT[] AS used, -1::BIGINT AS invoice_id, -1::BIGINT AS deal_id, 0 AS points, false AS taken FROM (SELECT DISTINCT customer FROM line)
 UNION ALL SELECT w.customer, l.k, CASE WHEN list_has_any(used, [l.invoice_id, l.deal_id]) THEN used ELSE used || [l.invoice_id, l.deal_id] END, l.invoice_id, l.deal_id, l.points, NOT list_has_any(used, [l.invoice_id, l.deal_id])
 FROM walk w JOIN line l ON l.customer = w.customer AND l.k = w.k + 1)
SELECT invoice_id, deal_id, points FROM walk WHERE taken""")
def link_one_to_one(t):
    """Invoices to deals of the customer by amount and by the quantity in the deal's name; several may fit, each is used once."""
    k = F.col("invoice_id")
    inv = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("customer")).agg(
        r2(F.sum("l_extendedprice")).alias("amount"), (F.sum("l_quantity").cast("long") * 10).alias("quantity"))
    q = F.col("quantity")
    name = F.when(k % 2 == 0, F.concat(F.lit("Renewal, "), F.format_number(q - q % 50, 0), F.lit(" seats"))).when(k % 5 == 0, F.concat(F.lit("Add-on "), q.cast("string"))).otherwise("New deal")
    deals = inv.select((k + 7_000_000_000).alias("deal_id"), "customer", F.when(k % 3 == 0, F.round(F.col("amount") / 1000) * 1000).otherwise(F.col("amount")).alias("deal_amount"), name.alias("deal_name"))
    copies = inv.groupBy("customer").agg((F.min("invoice_id") + 9_000_000_000).alias("deal_id"), F.min("amount").alias("deal_amount")).withColumn("deal_name", F.lit("Copy"))
    pairs = linking.amount_and_quantity(inv, deals.unionByName(copies), ["customer"], "amount", "quantity", "deal_amount", "deal_name")
    return linking.one_to_one(pairs, "invoice_id", "deal_id", [-F.col("points")]).select("invoice_id", "deal_id", "points")


@query("revenue_waterfall", covers="P40a", sql="""WITH s AS (SELECT l_returnflag, l_linestatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS created,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_extendedprice AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
x AS (SELECT *, CAST(unnest(generate_series(created, period, INTERVAL 1 MONTH)) AS DATE) AS as_of_period FROM s WHERE created <= period)
SELECT as_of_period, l_returnflag, count(*) AS lines, round(sum(amount), 4) AS transactional_amount,
 round(sum(amount * CASE l_returnflag WHEN 'A' THEN 1.1 WHEN 'N' THEN 0.9 ELSE 1.0 END), 4) AS functional_amount,
 round(sum(amount * CASE l_returnflag WHEN 'A' THEN 1.1 WHEN 'N' THEN 0.9 ELSE 1.0 END * CASE l_linestatus WHEN 'F' THEN 0.5 ELSE 2.0 END), 4) AS reporting_amount
FROM x GROUP BY 1, 2""")
def revenue_waterfall(t):
    sch = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "l_returnflag", "l_linestatus", i.month("o_orderdate").alias("created"), i.month("l_shipdate").alias("period")
    ).agg(F.count("*").alias("lines"), F.sum("l_extendedprice").alias("amount"))
    w = revenue.revenue_waterfall(sch, "created", "period", "amount",
                                  F.when(F.col("l_returnflag") == "A", 1.1).when(F.col("l_returnflag") == "N", 0.9).otherwise(1.0),
                                  F.when(F.col("l_linestatus") == "F", 0.5).otherwise(2.0))
    return w.groupBy("as_of_period", "l_returnflag").agg(
        F.sum("lines").alias("lines"), *[r4(F.sum(f"{k}_amount")).alias(f"{k}_amount") for k in ("transactional", "functional", "reporting")])


@query("snapshot_pick", covers="P35", sql="""SELECT CAST(o_orderdate AS DATE) AS snapshot_date, count(*) AS orders, round(sum(o_totalprice), 2) AS amount FROM orders
WHERE (o_orderdate < DATE '1997-01-01' AND day(o_orderdate) = 8) OR (o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01' AND day(o_orderdate) = 5)
 OR (o_orderdate >= DATE '1999-01-01' AND day(o_orderdate) = 4) GROUP BY 1""")
def snapshot_pick(t):
    daily = t.orders.select(i.day("o_orderdate").alias("snapshot_date"), "o_totalprice")
    picked = revenue.snapshot_pick(daily, "snapshot_date", [
        (dt.date(1900, 1, 1), dt.date(1997, 1, 1), 8), (dt.date(1997, 1, 1), dt.date(1999, 1, 1), 5), (dt.date(1999, 1, 1), dt.date(9999, 1, 1), 4)])
    return picked.groupBy("snapshot_date").agg(F.count("*").alias("orders"), r2(F.sum("o_totalprice")).alias("amount"))


# --- keys -------------------------------------------------------------------------------------

@query("latest_event_per_user", covers="P01 O03 F18 W01", sql="""SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_user(t):
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return keys.latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


@query("distinct_source", covers="P02", sql="""SELECT user_id, event_type, min(ts) AS valid_from, max(ts) AS last_loaded_at FROM events GROUP BY 1, 2""")
def distinct_source(t):
    return keys.distinct_source(t.events, ["user_id", "event_type"], "ts")


@query("stale_order_attributes", covers="P08 T11", sql="""SELECT o_orderkey, o_custkey, segment FROM (SELECT o_orderkey, o_custkey, c_mktsegment AS segment,
 CASE WHEN c_custkey % 7 = 0 THEN 'REASSIGNED' ELSE c_mktsegment END AS now_segment FROM orders JOIN customer ON o_custkey = c_custkey) WHERE segment IS DISTINCT FROM now_segment""")
def stale_order_attributes(t):
    fact = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_custkey", F.col("c_mktsegment").alias("segment"))
    dim = t.customer.select(F.col("c_custkey").alias("o_custkey"),
                            F.when(F.col("c_custkey") % 7 == 0, "REASSIGNED").otherwise(F.col("c_mktsegment")).alias("segment"))
    return keys.propagate_dimension_changes(fact, dim, "o_custkey", ["segment"])


@query("surrogate_keys", covers="P17 M05", sql="""SELECT l_orderkey, l_linenumber, md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag)) AS line_key,
 CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_id, md5(concat_ws('-', CAST(l_orderkey AS VARCHAR), coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_'))) AS null_key FROM lineitem""")
def surrogate_keys(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", s.surrogate_key(["l_orderkey", "l_linenumber", "l_returnflag"]).alias("line_key"),
                             s.date_id("l_shipdate").alias("ship_date_id"),
                             s.surrogate_key(["l_orderkey", F.nullif("l_returnflag", F.lit("N"))]).alias("null_key"))


@query("hash_pii", covers="P18", sql="""SELECT c_custkey, c_mktsegment, sha256('pepper' || lower(trim(c_name))) AS c_name_hash FROM customer""")
def hash_pii(t):
    return keys.hash_pii(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_name"], "pepper")


@query("hash_diff", covers="P18 S16", sql="""WITH now AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 11 <> 0),
was AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 13 <> 0),
j AS (SELECT coalesce(n.c_custkey, w.c_custkey) AS c_custkey, CASE WHEN w.c_custkey IS NULL THEN 'inserted' WHEN n.c_custkey IS NULL THEN 'deleted'
 WHEN n.c_name <> w.c_name OR n.c_mktsegment <> w.c_mktsegment THEN 'changed' ELSE 'unchanged' END AS status FROM now n FULL JOIN was w ON n.c_custkey = w.c_custkey)
SELECT c_custkey, status, CASE WHEN status = 'unchanged' THEN DATE '2001-01-01' ELSE DATE '2001-12-31' END AS last_changed FROM j""")
def hash_diff(t):
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    now = c.where(F.col("c_custkey") % 11 != 0).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "MOVED").otherwise(F.col("c_mktsegment")))
    was = c.where(F.col("c_custkey") % 13 != 0).withColumn("last_changed", F.lit(dt.date(2001, 1, 1)))
    return keys.hash_diff(now, was, "c_custkey", ["c_name", "c_mktsegment"], i.ORDERS_AS_OF)


@query("with_audit", covers="P85 S18", sql="""SELECT *, '@builder' AS created_by, '@builder' AS updated_by, DATE '2024-01-01' AS model_created_date, DATE '2024-01-02' AS model_updated_date, true AS is_built FROM nation""")
def with_audit(t):
    """All but the build time itself, of which only its presence can be compared."""
    built = keys.with_audit(t.nation, "@builder", "@builder", "2024-01-01", "2024-01-02")
    return built.withColumn("is_built", F.col("built_at") <= F.current_timestamp()).drop("built_at")


@query("missing_member", covers="P89 U01", sql="""WITH dim AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT md5('-1'), 'Missing member'),
f AS (SELECT o_orderkey, coalesce(CAST(CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS VARCHAR), md5('-1')) AS customer_id FROM orders)
SELECT name, count(*) AS orders FROM f JOIN dim USING (customer_id) GROUP BY 1""")
def missing_member(t):
    dim = t.customer.where(F.col("c_custkey") % 10 != 0).select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"))
    import hashlib
    dim = keys.with_missing_member(dim, {"customer_id": hashlib.md5(b"-1").hexdigest(), "name": "Missing member"})
    fact = t.orders.select("o_orderkey", s.keyed_null(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey"))).alias("customer_id"))
    # counted per key before the join: the missing member is the hot key by design
    per_key = fact.groupBy("customer_id").agg(F.count("*").alias("orders"))
    return per_key.join(dim, "customer_id").groupBy("name").agg(F.sum("orders").alias("orders"))


@query("single_field_dimension", covers="P90 F21", sql="""SELECT md5(c_mktsegment) AS segment_id, c_mktsegment AS segment FROM (SELECT DISTINCT c_mktsegment FROM customer) UNION ALL SELECT md5('-1'), 'Missing segment'""")
def single_field_dimension(t):
    return keys.single_field_dimension(t.customer, "c_mktsegment", "segment_id", "segment")


# --- calendar ----------------------------------------------------------------------------------

DIM_SQL = """WITH RECURSIVE span AS (SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS a, CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS b FROM orders),
spine AS (SELECT CAST(unnest(generate_series(a - INTERVAL 11 MONTH, b + INTERVAL 1 MONTH, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
base AS (SELECT d, year(d) AS y, month(d) AS m, isodow(d) AS dow,
  CASE WHEN month(d) < 2 THEN year(d) ELSE year(d) + 1 END AS fy,
  CASE WHEN month(d) < 2 THEN '4' WHEN month(d) < 5 THEN '1' WHEN month(d) < 8 THEN '2' WHEN month(d) < 11 THEN '3' ELSE '4' END AS fq,
  CASE WHEN strftime(d, '%m-%d') = '01-01' THEN 'New Year''s Day' WHEN strftime(d, '%m-%d') = '12-25' THEN 'Christmas Day' WHEN strftime(d, '%m-%d') = '12-26' THEN 'Boxing Day' END AS hol FROM spine),
w AS (SELECT *, min(d) OVER (PARTITION BY fy, fq) AS fq0, max(d) OVER (PARTITION BY fy, fq) AS fq1, min(d) OVER (PARTITION BY fy) AS fy0, max(d) OVER (PARTITION BY fy) AS fy1,
  min(d) OVER (PARTITION BY y, m) AS m0, max(d) OVER (PARTITION BY y, m) AS m1,
  row_number() OVER (PARTITION BY fy, fq ORDER BY d) AS dfq, row_number() OVER (PARTITION BY fy ORDER BY d) AS dfy,
  CASE WHEN dow < 6 AND hol IS NULL THEN sum(CASE WHEN dow < 6 AND hol IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY fy, fq ORDER BY d) END AS bd,
  12 - CAST(floor(date_diff('day', d, max(d) OVER (PARTITION BY fy, fq)) / 7.0) AS INTEGER) AS wn FROM base)
SELECT d AS date_day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, strftime(d, '%a') AS day_name, CAST(m AS INTEGER) AS month_actual, CAST(y AS INTEGER) AS year_actual, CAST(quarter(d) AS INTEGER) AS quarter_actual,
 CAST(dow AS INTEGER) AS day_of_week, CAST(date_trunc('week', d) AS DATE) AS first_day_of_week, CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS last_day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
 CAST(date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1 AS INTEGER) AS day_of_quarter, CAST(dayofyear(d) AS INTEGER) AS day_of_year, strftime(d, '%B') AS month_name, m0 AS first_day_of_month, m1 AS last_day_of_month,
 CAST(fy AS INTEGER) AS fiscal_year, fq AS fiscal_quarter, CAST(CASE WHEN m = 1 THEN 12 ELSE m - 1 END AS INTEGER) AS month_of_fiscal_year, fq0 AS first_day_of_fiscal_quarter, fq1 AS last_day_of_fiscal_quarter, fy0 AS first_day_of_fiscal_year, fy1 AS last_day_of_fiscal_year,
 CAST(fy AS VARCHAR) || '-Q' || fq AS fiscal_quarter_name, 'FY' || substr(CAST(fy AS VARCHAR), 3, 2) || '-Q' || fq AS fiscal_quarter_name_fy, CAST(fy AS VARCHAR) || '-' || strftime(d, '%b') AS fiscal_month_name,
 hol AS holiday_desc, hol IS NOT NULL AS is_holiday, CAST(dfq AS INTEGER) AS day_of_fiscal_quarter, CAST(dfy AS INTEGER) AS day_of_fiscal_year,
 CAST(date_diff('day', date_trunc('week', fy0), date_trunc('week', d)) // 7 + 1 AS INTEGER) AS week_of_fiscal_year, CAST(floor(date_diff('day', fq0, d) / 7.0) AS INTEGER) AS week_of_fiscal_quarter,
 CAST(90 - date_diff('day', d, fq1) AS INTEGER) AS day_of_fiscal_quarter_normalised, wn AS week_of_fiscal_quarter_normalised, CASE WHEN wn < 5 THEN wn WHEN wn < 9 THEN wn - 4 ELSE wn - 8 END AS week_of_month_normalised,
 CAST(365 - date_diff('day', d, fy1) AS INTEGER) AS day_of_fiscal_year_normalised, CASE WHEN (date_diff('day', d, fq1) - 6) % 7 = 0 OR d = fq0 THEN 1 ELSE 0 END AS is_first_day_of_fiscal_quarter_week,
 CAST(date_diff('day', d, m1) AS INTEGER) AS days_until_last_day_of_month, CAST(bd AS INTEGER) AS business_day_of_quarter, CAST(date_trunc('month', fq1) AS DATE) = d AS is_first_day_of_last_month_of_fiscal_quarter,
 CAST(m0 + INTERVAL 1 MONTH + INTERVAL 7 DAY AS DATE) AS snapshot_date_eighth
FROM w"""

DIM_COLS = """date_day date_id day_name month_actual year_actual quarter_actual day_of_week first_day_of_week last_day_of_week week_of_year day_of_quarter day_of_year
month_name first_day_of_month last_day_of_month fiscal_year fiscal_quarter month_of_fiscal_year first_day_of_fiscal_quarter last_day_of_fiscal_quarter
first_day_of_fiscal_year last_day_of_fiscal_year fiscal_quarter_name fiscal_quarter_name_fy fiscal_month_name holiday_desc is_holiday day_of_fiscal_quarter day_of_fiscal_year week_of_fiscal_year
week_of_fiscal_quarter day_of_fiscal_quarter_normalised week_of_fiscal_quarter_normalised week_of_month_normalised day_of_fiscal_year_normalised
is_first_day_of_fiscal_quarter_week days_until_last_day_of_month business_day_of_quarter is_first_day_of_last_month_of_fiscal_quarter snapshot_date_eighth""".split()


@query("date_dimension", covers="P19 S09 W07 W20", sql=DIM_SQL)
def date_dimension(t):
    ends = t.orders.agg(F.trunc(F.min("o_orderdate"), "year").alias("a"), F.trunc(F.max("o_orderdate"), "year").alias("b"))
    spine = ends.select(F.explode(F.sequence(F.add_months("a", -11), F.date_add(F.add_months("b", 12), 30), i.one_day())).alias("date_day"))
    return calendar.date_dimension(spine).select(*DIM_COLS)


@query("densify_orders", covers="P20", sql=f"""WITH {i.SQL_ACCOUNT_MONTH}, {i.SQL_ACCOUNT_DENSE}
SELECT account_id, month, amount, quantity, tier FROM account_dense""")
def densify_orders(t):
    return calendar.densify(i.account_month(t), ["account_id"], "month", 1, ["amount", "quantity", "tier"]).select("account_id", "month", "amount", "quantity", "tier")


@query("expand_charges_monthly", covers="P21 J09 M05", sql=f"""WITH {i.SQL_CHARGE},
x AS (SELECT *, CAST(unnest(generate_series(start_date, CAST(end_date - INTERVAL 1 DAY AS DATE), INTERVAL 1 MONTH)) AS DATE) AS period FROM charge)
SELECT account_id, period, count(*) AS charges, round(sum(mrr), 4) AS mrr, round(sum(mrr) * 12, 2) AS yearly FROM x GROUP BY 1, 2""")
def expand_charges_monthly(t):
    grain = i.charge(t).groupBy("account_id", "start_date", "end_date").agg(F.count("*").alias("n"), F.sum("mrr").alias("mrr"))
    # dealt by account before the months are made, so these never travel; an account has at most a row per start and end by now
    x = calendar.expand_interval(dealt(grain, "account_id"), "start_date", "end_date", "month")
    return x.groupBy("account_id", "period").agg(F.sum("n").alias("charges"), r4(F.sum("mrr")).alias("mrr"), r2(F.sum("mrr") * 12).alias("yearly"))


@query("expand_plan_daily", covers="P21 J10", sql=f"""WITH {i.SQL_PLAN_HISTORY},
x AS (SELECT *, CAST(unnest(generate_series(valid_from, coalesce(CAST(valid_to - INTERVAL 1 DAY AS DATE), DATE '2001-12-31'), INTERVAL 1 DAY)) AS DATE) AS period FROM plan_history)
SELECT period, value, count(*) AS customers FROM x GROUP BY 1, 2""")
def expand_plan_daily(t):
    x = calendar.open_per_day(i.plan_history(t), ["value"], "valid_from", "valid_to", i.ORDERS_AS_OF, name="period")
    return x.select("period", "value", F.col("open_count").alias("customers"))
