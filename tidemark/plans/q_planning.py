"""Targets, stages, attribution, scaffolds and matching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import calendar, planning
from tidemark.plans import inputs as i
from tidemark.plans.registry import query

r2 = lambda x: F.round(x, 2)
r4 = lambda x: F.round(x, 4)
r6 = lambda x: F.round(x, 6)

SQL_TARGETS = """targets AS (SELECT c_mktsegment AS segment, c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) + INTERVAL 12 MONTH AS DATE) AS month, round(sum(o_totalprice), 2) * 1.1 AS target FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""


def targets(t):
    """Last year's orders of a segment, nation and month, raised by a tenth."""
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.add_months(i.month("o_orderdate"), 12).alias("month")).agg(
        (r2(F.sum("o_totalprice")) * 1.1).alias("target"))


@query("targets_daily", covers="P44", sql=f"""WITH {SQL_TARGETS}, d AS (SELECT segment, nation, CAST(unnest(generate_series(month, CAST(last_day(month) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day, target / day(last_day(month)) AS daily_target FROM targets)
SELECT segment, day, round(sum(daily_target), 5) AS daily_target FROM d GROUP BY 1, 2""")
def targets_daily(t):
    seg = targets(t).groupBy("segment", "month").agg(F.sum("target").alias("target"))
    return planning.allocate_target_daily(seg, "month", "target").select("segment", "day", F.round("daily_target", 5).alias("daily_target"))


@query("to_date_totals", covers="P43 W10", sql="""WITH d AS (SELECT c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS amount FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT segment, day, round(sum(amount) OVER (PARTITION BY segment, date_trunc('week', day) ORDER BY day), 2) AS amount_wtd, round(sum(amount) OVER (PARTITION BY segment, date_trunc('month', day) ORDER BY day), 2) AS amount_mtd,
 round(sum(amount) OVER (PARTITION BY segment, date_trunc('quarter', day) ORDER BY day), 2) AS amount_qtd, round(sum(amount) OVER (PARTITION BY segment, date_trunc('year', day) ORDER BY day), 2) AS amount_ytd FROM d""")
def to_date_totals(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment"), i.day("o_orderdate").alias("day")).agg(r2(F.sum("o_totalprice")).alias("amount"))
    out = planning.to_date_totals(d, ["segment"], "day", "amount")
    return out.select("segment", "day", *[r2(f"amount_{k}").alias(f"amount_{k}") for k in ("wtd", "mtd", "qtd", "ytd")])


SQL_STAGES = f"""{i.SQL_STAGE_DATES}, h AS (SELECT item_id, CASE WHEN stage = 'error' THEN 'lost' WHEN stage = 'purchase' THEN 'won' ELSE stage END AS stage, stage_date, min(stage_date) OVER (PARTITION BY item_id) AS created FROM stage_history WHERE NOT (stage = 'error' AND item_id % 3 <> 0) AND NOT (stage = 'purchase' AND item_id % 3 <> 1) AND NOT (stage = 'view' AND item_id % 5 = 0))"""


def stages(t):
    h = i.stage_history(t)
    x = F.col("item_id")
    h = h.where(~((F.col("stage") == "error") & (x % 3 != 0)) & ~((F.col("stage") == "purchase") & (x % 3 != 1)) & ~((F.col("stage") == "view") & (x % 5 == 0)))
    kept = h.withColumn("stage", F.when(F.col("stage") == "error", "lost").when(F.col("stage") == "purchase", "won").otherwise(F.col("stage")))
    return kept.join(kept.groupBy("item_id").agg(F.min("stage_date").alias("created")), "item_id")


@query("stage_progression", covers="P45 A24", sql=f"""WITH {SQL_STAGES}, p AS (SELECT item_id, min(created) AS created_date, max(stage_date) FILTER (stage = 'signup') AS s0, max(stage_date) FILTER (stage = 'view') AS s1, max(stage_date) FILTER (stage = 'click') AS s2,
 max(stage_date) FILTER (stage = 'lost') AS lost, max(stage_date) FILTER (stage = 'won') AS won FROM h GROUP BY 1),
c AS (SELECT item_id, created_date, CASE WHEN lost IS NOT NULL THEN 'Lost' WHEN won IS NOT NULL THEN 'Won' ELSE 'Open' END AS stage_category, coalesce(lost, won) AS close_date, coalesce(s0, created_date) AS signup_date,
 CASE WHEN lost IS NULL AND won IS NULL THEN coalesce(s1, s2) ELSE coalesce(s1, s2, lost, won) END AS view_date, CASE WHEN lost IS NULL AND won IS NULL THEN s2 ELSE coalesce(s2, lost, won) END AS click_date FROM p)
SELECT *, greatest(date_diff('day', signup_date, view_date), CASE WHEN view_date IS NOT NULL THEN 0 END) AS signup_days, greatest(date_diff('day', view_date, click_date), CASE WHEN click_date IS NOT NULL AND view_date IS NOT NULL THEN 0 END) AS view_days,
 greatest(date_diff('day', click_date, close_date), CASE WHEN click_date IS NOT NULL AND close_date IS NOT NULL THEN 0 END) AS click_days, CASE WHEN stage_category = 'Open' THEN date_diff('day', coalesce(click_date, view_date, signup_date, created_date), DATE '2024-01-31') END AS current_days FROM c""")
def stage_progression(t):
    return planning.stage_progression(stages(t), "item_id", "stage", "stage_date", "created", ["signup", "view", "click"], "lost", "won", i.EVENTS_AS_OF)


STAGE_NO = {"signup": 1, "view": 2, "click": 3, "purchase": 4, "error": 5}
SQL_STAGE_NO = "CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END"


@query("stage_regression", covers="P46", sql=f"""WITH n AS (SELECT user_id, {SQL_STAGE_NO} AS n, lag({SQL_STAGE_NO}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events WHERE event_type <> 'error') SELECT user_id, max(CASE WHEN p > n THEN 1 ELSE 0 END) AS is_stage_regression FROM n GROUP BY 1""")
def stage_regression(t):
    from tidemark.functions.scalars import decode
    e = t.events.where(F.col("event_type") != "error").select("user_id", "ts", "event_id", decode("event_type", STAGE_NO).alias("n"))
    return planning.stage_regression(e, "user_id", "n", ["ts", "event_id"])


@query("journey", covers="P47", sql=f"""WITH {i.SQL_STAGE_DATES} SELECT item_id, CAST(row_number() OVER w AS BIGINT) AS stage_order, stage, stage_ts AS entry_at, lead(stage_ts) OVER w AS exit_at, lead(stage) OVER w AS next_stage, date_diff('day', CAST(stage_ts AS DATE), CAST(lead(stage_ts) OVER w AS DATE)) AS days_in_stage
FROM stage_history WINDOW w AS (PARTITION BY item_id ORDER BY stage_ts, stage)""")
def journey(t):
    return planning.journey(i.stage_history(t), "item_id", "stage", ["stage_ts", "stage"])


@query("stage_funnel", covers="P112", sql="""WITH g AS (SELECT user_id AS item_id, min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'view') AS b, min(ts) FILTER (event_type = 'purchase') AS c FROM events GROUP BY 1)
SELECT item_id, a IS NOT NULL AS hit_signup, b IS NOT NULL AS hit_view, c IS NOT NULL AS hit_purchase, date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) AS turn_signup_to_view, date_diff('day', CAST(b AS DATE), CAST(c AS DATE)) AS turn_view_to_purchase,
 CASE WHEN c IS NOT NULL THEN 'purchase' WHEN b IS NOT NULL THEN 'view' WHEN a IS NOT NULL THEN 'signup' END AS furthest_stage FROM g""")
def stage_funnel(t):
    return planning.stage_funnel(i.stage_history(t), "item_id", "stage", "stage_ts", ["signup", "view", "purchase"])


SQL_TOUCH = """tc AS (SELECT e.event_id, e.user_id, e.ts, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS channel, (SELECT min((p.ts, p.event_id)) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts >= e.ts) AS cv FROM events e WHERE event_type IN ('view', 'click')),
l AS (SELECT event_id, channel, ts, cv[2] AS conversion, CASE channel WHEN 0 THEN 0.1 WHEN 1 THEN 0.2 WHEN 2 THEN 0.3 ELSE 0.0 END::DOUBLE AS w FROM tc WHERE cv IS NOT NULL),
a AS (SELECT *, min(ts) OVER p AS f, max(ts) OVER p AS z, sum(w) OVER p AS sw FROM l WINDOW p AS (PARTITION BY conversion)),
b AS (SELECT *, CASE WHEN sw = 0 THEN 0 ELSE w / sw END AS dw, 1 - least(1, date_diff('day', CAST(f AS DATE), CAST(ts AS DATE)) / 180) AS fw, 1 - least(1, date_diff('day', CAST(ts AS DATE), CAST(z AS DATE)) / 180) AS lw FROM a),
c AS (SELECT *, 0.67 * lw / sum(lw) OVER p + 0.33 * fw / sum(fw) OVER p AS td FROM b WINDOW p AS (PARTITION BY conversion)),
d AS (SELECT *, 0.4 * td + 0.6 * dw AS bl FROM c)"""


@query("attribution", covers="P48 F16", sql=f"""WITH {SQL_TOUCH} SELECT conversion, event_id, channel, round(td, 6) AS time_decay_weight, round(dw, 6) AS data_weight, round(bl / sum(bl) OVER (PARTITION BY conversion), 6) AS weight FROM d""")
def attribution(t):
    k = F.get_json_object("props", "$.k").cast("int")
    touches = t.events.where(F.col("event_type").isin("view", "click")).select("user_id", "ts", "event_id", (k % 4).alias("channel"))
    conv = t.events.where(F.col("event_type") == "purchase").select("user_id", "ts", F.col("event_id").alias("conversion_id"))
    w = F.when(F.col("channel") == 0, 0.1).when(F.col("channel") == 1, 0.2).when(F.col("channel") == 2, 0.3).otherwise(0.0)
    a = planning.attribution(touches, conv, "user_id", "ts", "event_id", "conversion_id", "channel", w)
    return a.select("conversion", "event_id", "channel", *[r6(x).alias(x) for x in ("time_decay_weight", "data_weight", "weight")])


@query("targets_and_actuals", covers="P50 J05", sql=f"""WITH {SQL_TARGETS}, a AS (SELECT c_mktsegment AS segment, c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS actual FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
g AS (SELECT * FROM (SELECT segment, nation FROM targets UNION SELECT segment, nation FROM a) CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(month) FROM a), (SELECT max(month) FROM targets), INTERVAL 1 MONTH)) AS DATE) AS period))
SELECT g.segment, g.nation, period, actual, round(target, 3) AS target FROM g LEFT JOIN a ON a.segment = g.segment AND a.nation = g.nation AND a.month = period LEFT JOIN targets x ON x.segment = g.segment AND x.nation = g.nation AND x.month = period""")
def targets_and_actuals(t):
    tg = targets(t).withColumnRenamed("month", "period")
    a = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), i.month("o_orderdate").alias("period")).agg(r2(F.sum("o_totalprice")).alias("actual"))
    # from the first month with orders to the last with a target, a year after the last order
    months = F.sequence(a.agg(F.min("period")).scalar(), tg.agg(F.max("period")).scalar(), F.expr("INTERVAL 1 MONTH"))
    g = planning.scaffold([tg.select("segment", "nation"), a.select("segment", "nation")], months)
    key = ["segment", "nation", "period"]
    return g.join(a, key, "left").join(tg, key, "left").select(*key, "actual", F.round("target", 3).alias("target"))


SQL_FISCAL = """CAST('FY' || substr(CAST(year({d} - INTERVAL 1 MONTH) + 1 AS VARCHAR), 3, 2) || '-Q' || quarter({d} - INTERVAL 1 MONTH) AS VARCHAR)"""


@query("quarter_coverage", covers="P49", sql=f"""WITH s AS (SELECT o_orderstatus AS status, CAST(o_orderdate AS DATE) AS snapshot_date, CAST(o_orderdate + to_days(CAST(o_orderkey % 120 AS INTEGER)) AS DATE) AS close_date, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS oa, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS ba FROM orders),
q AS (SELECT *, {SQL_FISCAL.format(d="date_trunc('month', close_date)")} AS close_quarter, CAST(date_trunc('quarter', date_trunc('month', close_date) - INTERVAL 1 MONTH) + INTERVAL 4 MONTH - INTERVAL 1 DAY AS DATE) AS qe FROM s),
d AS (SELECT status, close_quarter, snapshot_date, CAST(90 - date_diff('day', snapshot_date, qe) AS INTEGER) AS snapshot_day, sum(oa) AS oa, sum(ba) AS ba FROM q GROUP BY 1, 2, 3, 4 HAVING snapshot_day BETWEEN -92 AND 90),
tg AS (SELECT status, close_quarter, sum(ba) * 2 + 1 AS target FROM q GROUP BY 1, 2),
dims AS (SELECT status, close_quarter FROM d UNION SELECT status, close_quarter FROM tg), days AS (SELECT DISTINCT close_quarter, snapshot_date, snapshot_day FROM d)
SELECT dims.status, dims.close_quarter, days.snapshot_date, days.snapshot_day, round(coalesce(oa, 0), 2) AS open_amount, round(coalesce(ba, 0), 2) AS booked_amount, round(target, 2) AS target, round(coalesce(oa, 0) / nullif(target - coalesce(ba, 0), 0), 6) AS coverage
FROM dims JOIN days ON dims.close_quarter = days.close_quarter LEFT JOIN d ON d.status = dims.status AND d.close_quarter = dims.close_quarter AND d.snapshot_date = days.snapshot_date LEFT JOIN tg ON tg.status = dims.status AND tg.close_quarter = dims.close_quarter""")
def quarter_coverage(t):
    from tidemark.operators.calendar import fiscal_attributes
    d, done = i.day("o_orderdate"), F.col("o_orderstatus") == "F"
    s = t.orders.select(F.col("o_orderstatus").alias("status"), d.alias("snap"), F.date_add(d, (F.col("o_orderkey") % 120).cast("int")).alias("close"),
                        F.when(done, 0.0).otherwise(F.col("o_totalprice")).alias("oa"), F.when(done, F.col("o_totalprice")).otherwise(0.0).alias("ba"))
    tg = s.groupBy("status", fiscal_attributes(F.col("close"))["fiscal_quarter_name_fy"].alias("close_quarter")).agg((F.sum("ba") * 2 + 1).alias("target"))
    q = planning.quarter_coverage(s, tg, ["status"], "snap", "close", "oa", "ba")
    return q.withColumns({"open_amount": r2("open_amount"), "booked_amount": r2("booked_amount"), "target": r2("target"), "coverage": r6("coverage")})


@query("ramp_status", covers="P51a", sql="""WITH p AS (SELECT s_suppkey, s_nationkey, DATE '2000-01-01' + CAST(s_suppkey % 200 AS INTEGER) AS a, CASE WHEN s_suppkey % 4 = 0 THEN DATE '2001-06-01' END AS b FROM supplier), x AS (SELECT *, CAST(unnest(generate_series(a, coalesce(CAST(b - INTERVAL 1 DAY AS DATE), DATE '2001-12-31'), INTERVAL 1 DAY)) AS DATE) AS day FROM p)
SELECT day, s_nationkey, count(*) FILTER (date_diff('day', a, day) < 90) AS ramping, count(*) FILTER (date_diff('day', a, day) >= 90) AS ramped FROM x GROUP BY 1, 2""")
def ramp_status(t):
    p = t.supplier.select("s_suppkey", "s_nationkey", F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("s_suppkey") % 200).cast("int")).alias("a"),
                          F.when(F.col("s_suppkey") % 4 == 0, F.lit(dt.date(2001, 6, 1))).alias("b"))
    r = calendar.open_per_day(planning.ramp_intervals(p, "a", "b", 90), ["s_nationkey", "ramp_status"], "ramp_from", "ramp_to", i.ORDERS_AS_OF)
    return r.groupBy("day", "s_nationkey").agg(*[F.coalesce(F.sum(F.when(F.col("ramp_status") == k, F.col("open_count"))), F.lit(0)).alias(k) for k in ("ramping", "ramped")])


@query("forecast_buckets", covers="P52a", sql="""WITH b AS (SELECT o_custkey, date_trunc('quarter', o_orderdate) AS q, sum(o_totalprice) AS amount FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2), s AS (SELECT DISTINCT o_custkey, date_trunc('quarter', o_orderdate) AS q FROM orders WHERE o_orderstatus = 'O')
SELECT CAST(b.q AS DATE) AS quarter, CASE WHEN s.o_custkey IS NOT NULL THEN 'from open business' ELSE 'new in quarter' END AS bucket, count(*) AS accounts, round(sum(amount), 2) AS amount FROM b LEFT JOIN s ON b.o_custkey = s.o_custkey AND b.q = s.q GROUP BY 1, 2""")
def forecast_buckets(t):
    o = t.orders.withColumn("quarter", F.trunc("o_orderdate", "quarter"))
    booked = o.where(F.col("o_orderstatus") == "F").groupBy("o_custkey", "quarter").agg(F.sum("o_totalprice").alias("amount"))
    return planning.forecast_buckets(booked, o.where(F.col("o_orderstatus") == "O"), "o_custkey", "quarter").groupBy("quarter", "bucket").agg(F.count("*").alias("accounts"), r2(F.sum("amount")).alias("amount"))


SQL_BOOKED = """o AS (SELECT o_orderkey AS k, o_custkey AS account, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, CAST(o_orderdate AS DATE) AS closed, o_orderstatus <> 'P' AS won, o_totalprice AS amount FROM orders),
third AS (SELECT quarter, d AS third_day FROM (SELECT quarter, d, row_number() OVER (PARTITION BY quarter ORDER BY d) AS n FROM (SELECT quarter, CAST(unnest(generate_series(quarter, quarter + INTERVAL 14 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT quarter FROM o))
 WHERE isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ('01-01', '12-25', '12-26')) WHERE n = 3),
s AS (SELECT account, quarter, CAST(quarter + to_months(CAST(3 * (k % 2) AS INTEGER)) AS DATE) AS close_quarter FROM o JOIN third USING (quarter) WHERE k % 3 < 2)"""


@query("booking_buckets", covers="P52a", sql=f"""WITH {SQL_BOOKED}
SELECT k, account, o.quarter, CASE WHEN won AND k % 40 IN (0, 1) THEN 'Bad Debt' WHEN k % 9 BETWEEN 4 AND 6 THEN 'Churn/Contraction' WHEN k % 11 < 2 THEN 'Accounting' WHEN closed <= third_day THEN 'Already Booked'
 WHEN EXISTS (SELECT 1 FROM s WHERE s.account = o.account AND s.quarter = o.quarter AND close_quarter = o.quarter) THEN 'Starting'
 WHEN EXISTS (SELECT 1 FROM s WHERE s.account = o.account AND s.quarter = o.quarter AND close_quarter > o.quarter) THEN 'Pulled Forward' ELSE 'Created and Closed' END AS bucket FROM o JOIN third ON o.quarter = third.quarter""")
def booking_buckets(t):
    """Every third snapshot was taken on the day before the third business day and doesn't count."""
    k, day = F.col("k"), i.day("o_orderdate")
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("account"), F.trunc(day, "quarter").alias("quarter"), day.alias("closed"), (F.col("o_orderstatus") != "P").alias("won"))
    booked = o.select("*", F.when(k % 40 == 0, "Old Bad Debt").when(k % 40 == 1, "the BD part").otherwise("deal").alias("name"),
                      F.concat((k % 9).cast("string"), F.lit(". type")).alias("order_type"), F.when(k % 11 == 0, "Decommission").when(k % 11 == 1, "Internal fix").otherwise("Standard").alias("category"))
    third = calendar.nth_business_day(F.col("quarter"), 3)
    seen = o.select("account", "quarter", F.when(k % 3 < 2, third).otherwise(F.date_sub(third, 1)).alias("snapshot_date"), F.add_months("quarter", (3 * (k % 2)).cast("int")).alias("close_quarter"))
    return planning.booking_buckets(booked, seen, "account", "quarter", "closed", "name", "order_type", "category", F.col("won")).select("k", "account", "quarter", "bucket")


@query("match_entities", covers="P62", sql="""WITH l AS (SELECT s_suppkey AS left_id, CASE WHEN s_suppkey % 3 = 0 THEN 'n' || s_nationkey || '.example.com' END AS d, 'company' || (s_suppkey % 60) AS n FROM supplier),
r AS (SELECT c_custkey AS match_id, CASE WHEN c_custkey % 10 = 0 THEN 'n' || c_nationkey || '.example.com' END AS d, 'company' || (c_custkey % 90) AS n FROM customer WHERE c_custkey % 17 <> 0 AND 'company' || (c_custkey % 90) NOT LIKE 'company8%'),
top AS (SELECT n FROM l GROUP BY 1 ORDER BY count(*) DESC, n LIMIT 3), k AS (SELECT left_id, CASE WHEN NOT bad THEN d END AS d, CASE WHEN NOT bad THEN n END AS n FROM (SELECT *, n IN (SELECT n FROM top) AND n <> 'company1' AS bad FROM l)),
h AS (SELECT left_id, match_id, 'domain' AS rule, 1 AS p FROM k JOIN r USING (d) UNION ALL SELECT left_id, match_id, 'name', 2 FROM k JOIN r USING (n))
SELECT left_id, match_id, rule FROM h QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY p, match_id) = 1""")
def match_entities(t):
    """The three commonest names are bad guesses but for one; names like a pattern and accounts marked as duplicates are out."""
    left = t.supplier.select(F.col("s_suppkey").alias("left_id"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit(".Example.com"))).alias("domain"),
                             F.concat(F.lit("Company"), (F.col("s_suppkey") % 60).cast("string"), F.lit(" GmbH")).alias("name"))
    mark = F.when(F.col("c_custkey") % 17 == 0, " Dupe").otherwise("")
    right = t.customer.select(F.col("c_custkey").alias("right_id"), F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit(".example.com"))).alias("domain"),
                              F.concat(F.lit("COMPANY"), (F.col("c_custkey") % 90).cast("string"), F.lit(", Inc."), mark).alias("name"))
    return planning.match_entities(left, right, "left_id", "name", "domain", "right_id", "name", "domain", 3, ["company1"], ["company8%"], ["%dupe%"])


@query("company_score", covers="P63 W16", sql="""WITH d AS (SELECT l_suppkey % 50 AS grp, o_custkey % 7 AS company, o_custkey AS usr, CASE l_returnflag WHEN 'A' THEN 'creator' WHEN 'N' THEN 'owner' ELSE 'user' END AS role FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT grp, count(DISTINCT usr) AS au, count(DISTINCT CASE WHEN role = 'creator' THEN usr END) AS ac, count(DISTINCT CASE WHEN role = 'owner' THEN usr END) AS ao, count(DISTINCT CASE WHEN role = 'user' THEN usr END) AS aus FROM d GROUP BY 1),
p AS (SELECT grp, company, count(DISTINCT CASE WHEN role = 'creator' THEN usr END) AS n_creator, count(DISTINCT CASE WHEN role = 'owner' THEN usr END) AS n_owner, count(DISTINCT CASE WHEN role = 'user' THEN usr END) AS n_user FROM d GROUP BY 1, 2),
s AS (SELECT p.*, coalesce(n_creator / nullif(ac, 0), 0) * 0.6 + coalesce(n_owner / nullif(ao, 0), 0) * 0.3 + coalesce(n_user / nullif(aus, 0), 0) * 0.1 AS us, CASE WHEN (n_creator + n_owner + n_user) / au > 0.5 THEN 1 ELSE 0 END AS company_score,
 ((n_creator > 0 AND n_user > 0)::INT + (n_creator > 0 AND n_owner > 0)::INT + (n_owner > 0 AND n_user > 0)::INT) / 3 AS sp FROM p JOIN t USING (grp))
SELECT grp, company, n_creator, n_owner, n_user, round(us, 6) AS user_score, company_score, round((us + company_score + sp) / 3 * 100, 6) AS combined_score FROM s""")
def company_score(t):
    d = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_suppkey") % 50).alias("grp"), (F.col("o_custkey") % 7).alias("company"), F.col("o_custkey").alias("usr"),
        F.when(F.col("l_returnflag") == "A", "creator").when(F.col("l_returnflag") == "N", "owner").otherwise("user").alias("role"))
    c = planning.company_score(d, "grp", "company", "usr", "role")
    return c.select("grp", "company", "n_creator", "n_owner", "n_user", r6("user_score").alias("user_score"), "company_score", r6("combined_score").alias("combined_score"))


@query("aggregate_then_enrich", covers="P106", sql="""SELECT l_partkey AS part_id, count(*) AS lines, round(sum(l_extendedprice), 2) AS revenue, max(p_brand) AS brand, max(p_type) AS kind FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def aggregate_then_enrich(t):
    dim = t.part.select(F.col("p_partkey").alias("part_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))
    return planning.aggregate_then_enrich(t.lineitem.withColumnRenamed("l_partkey", "part_id"), "part_id", {"lines": F.count("*"), "revenue": r2(F.sum("l_extendedprice"))}, dim, ["brand", "kind"])


@query("unify_activities", covers="P109 U03", sql="""SELECT event_id, user_id, ts, event_type AS activity_type, event_type = 'click' AS is_person_activity, CASE WHEN event_type = 'click' THEN value END AS click_value, CASE WHEN event_type = 'view' THEN props END AS view_props FROM events WHERE event_type IN ('click', 'view', 'error')""")
def unify_activities(t):
    base = lambda k, *x: t.events.where(F.col("event_type") == k).select("event_id", "user_id", "ts", *x)
    u = planning.unify_activities({"click": base("click", F.col("value").alias("click_value")), "view": base("view", F.col("props").alias("view_props")), "error": base("error")},
                                  "user_id", "ts", "event_id", ["click"])
    return u.select("event_id", "user_id", "ts", "activity_type", "is_person_activity", "click_value", "view_props")


@query("lead_to_revenue", covers="P110", sql="""WITH p AS (SELECT c_custkey AS person_id, c_mktsegment AS segment FROM customer WHERE c_custkey % 4 <> 0), c AS (SELECT o_custkey AS person_id, min(CAST(o_orderdate AS DATE)) AS first_order, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT coalesce(p.person_id, c.person_id) AS person_id, segment, first_order, orders, CASE WHEN p.person_id IS NULL THEN 'conversion only' WHEN c.person_id IS NULL THEN 'person only' ELSE 'converted' END AS record_type FROM p FULL JOIN c ON p.person_id = c.person_id""")
def lead_to_revenue(t):
    p = t.customer.where(F.col("c_custkey") % 4 != 0).select(F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("segment"))
    c = t.orders.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("person_id")).agg(F.min(i.day("o_orderdate")).alias("first_order"), F.count("*").alias("orders"))
    return planning.lead_to_revenue(p, c, "person_id")
