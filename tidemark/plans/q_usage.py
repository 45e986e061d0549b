"""Events, sessions and product usage."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.operators import history, keys, ordered, sketches, usage
from tidemark.plans import inputs as i
from tidemark.plans.registry import query
from tidemark.session import shared_dir

r2 = lambda x: F.round(x, 2)
r4 = lambda x: F.round(x, 4)
K = lambda: F.get_json_object("props", "$.k").cast("int")
K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


@query("sessions_by_gap", covers="P11 T13", sql=f"""WITH {i.SQL_SESSIONED}
SELECT user_id, session_index, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events FROM sessioned GROUP BY 1, 2""")
def sessions_by_gap(t):
    return i.sessioned(t).groupBy("user_id", "session_index").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("events"))


@query("session_window_variant", covers="T13", sql="""WITH gapped AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events),
s AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM gapped)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM s GROUP BY user_id, n""")
def session_window_variant(t):
    return t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("events")).select(
        "user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


SQL_PAGE_EVENTS = f"""pe AS (SELECT event_id, ts, user_id, user_id * 100000 + event_id % 500 AS page_id, CASE WHEN event_type = 'click' THEN 'page_ping' ELSE 'page_view' END AS kind,
 {K_SQL} AS k, {K_SQL} * 7 AS x, {K_SQL} * 31 AS y, CASE WHEN {K_SQL} % 11 = 0 THEN 0 ELSE 800 END AS w, CASE WHEN {K_SQL} % 13 = 0 THEN 0 ELSE 2000 END AS h,
 concat('/p/', CAST(event_id % 9 AS VARCHAR)) AS page_url FROM events WHERE event_type IN ('view', 'click')),
pv AS (SELECT page_id, arg_min(user_id, (ts, user_id, page_url)) FILTER (kind = 'page_view') AS user_id, arg_min(page_url, (ts, user_id, page_url)) FILTER (kind = 'page_view') AS page_url,
 min(ts) AS page_view_start, max(ts) AS page_view_end, count(*) FILTER (kind = 'page_view') AS page_view_count, count(*) FILTER (kind = 'page_ping') AS page_ping_count,
 max(CASE WHEN w <> 0 AND h <> 0 THEN w END) AS document_width, max(CASE WHEN w <> 0 AND h <> 0 THEN h END) AS document_height,
 min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pe GROUP BY 1),
views AS (SELECT *, page_ping_count * 30 AS time_engaged_in_s, CASE WHEN document_width IS NOT NULL THEN least(greatest(x1, 0), document_width) END AS scroll_x_max,
 CASE WHEN document_height IS NOT NULL THEN least(greatest(y1, 0), document_height) END AS scroll_y_max FROM pv WHERE page_view_count > 0),
pages_done AS (SELECT *, round(100.0 * scroll_x_max / document_width) AS horizontal_percentage_scrolled, round(100.0 * scroll_y_max / document_height) AS vertical_percentage_scrolled,
 page_ping_count > 0 AND coalesce(round(100.0 * scroll_y_max / document_height), 0) >= 25 AS user_engaged FROM views)"""


def page_events(t):
    k = K()
    return t.events.where(F.col("event_type").isin("view", "click")).select(
        "ts", "user_id", (F.col("user_id") * 100000 + F.col("event_id") % 500).alias("page_id"),
        F.when(F.col("event_type") == "click", "page_ping").otherwise("page_view").alias("kind"),
        (k * 7).alias("x"), (k * 31).alias("y"), F.when(k % 11 == 0, 0).otherwise(800).alias("w"), F.when(k % 13 == 0, 0).otherwise(2000).alias("h"),
        F.concat(F.lit("/p/"), (F.col("event_id") % 9).cast("string")).alias("page_url"))


def page_view_rows(t):
    return usage.page_views(page_events(t), "page_id", "kind", "ts", "w", "h", "x", "y", ["user_id", "page_url"])


@query("page_views", covers="P10", sql=f"""WITH {SQL_PAGE_EVENTS}
SELECT page_id, user_id, page_url, page_view_start, page_view_end, page_view_count, page_ping_count, time_engaged_in_s, document_width, document_height, scroll_x_max, scroll_y_max,
 horizontal_percentage_scrolled, vertical_percentage_scrolled, user_engaged FROM pages_done""")
def page_views(t):
    return page_view_rows(t).drop("scroll_x_min", "scroll_y_min")


@query("sessions_from_pages", covers="P11 A07 A08", sql=f"""WITH {SQL_PAGE_EVENTS}, s AS (SELECT *, CAST(page_view_start AS DATE) AS session_id FROM pages_done),
g AS (SELECT user_id, session_id, min(page_view_start) AS session_start, max(page_view_end) AS session_end, count(*) AS page_views, count(*) FILTER (user_engaged) AS engaged_page_views,
 CAST(sum(time_engaged_in_s) AS BIGINT) AS time_engaged_in_s, arg_min(page_url, (page_view_start, page_id)) AS first_page_url, arg_max(page_url, (page_view_end, page_id)) AS last_page_url FROM s GROUP BY 1, 2)
SELECT *, CASE WHEN time_engaged_in_s < 10 THEN '0s to 9s' WHEN time_engaged_in_s < 30 THEN '10s to 29s' WHEN time_engaged_in_s < 60 THEN '30s to 59s' WHEN time_engaged_in_s < 120 THEN '60s to 119s'
 WHEN time_engaged_in_s < 240 THEN '120s to 239s' ELSE '240s or more' END AS time_engaged_in_s_tier, page_views = 1 AS user_bounced, (page_views > 2 AND time_engaged_in_s > 59) OR engaged_page_views > 0 AS user_engaged,
 row_number() OVER (PARTITION BY user_id ORDER BY session_start) AS session_index FROM g""")
def sessions_from_pages(t):
    v = page_view_rows(t).withColumn("session_id", i.day("page_view_start"))
    s = usage.sessions(v, "user_id", "session_id", "page_id", "page_view_start", "page_view_end", "user_engaged", "time_engaged_in_s", ["page_url"])
    return ordered.with_row_index(s, ["user_id"], ["session_start"], None, "session_index")


@query("last_page_in_session", covers="P10", sql=f"""WITH {SQL_PAGE_EVENTS}, s AS (SELECT *, CAST(page_view_start AS DATE) AS session_id FROM pages_done)
SELECT page_id, user_id, session_id, CASE WHEN row_number() OVER (PARTITION BY user_id, session_id ORDER BY page_view_start DESC, page_id DESC) = 1 THEN 1 ELSE 0 END AS last_page_view_in_session FROM s""")
def last_page_in_session(t):
    v = page_view_rows(t).withColumn("session_id", i.day("page_view_start")).select("page_id", "user_id", "session_id", "page_view_start")
    return usage.with_last_in_session(v, ["user_id", "session_id"], "page_view_start", "page_id").drop("page_view_start")


AGENTS = ("Mozilla/5.0 (X11; Linux)", "Googlebot/2.1", "Mozilla/5.0 (Macintosh)", "BingPreview/1.0", "HeadlessChrome/90", "curl/8", "Yahoo! Slurp")
FAMILIES = ("'Chrome'", "'Robot/Spider'", "NULL")
KINDS = ("'Browser'", "NULL", "'Robot'", "'Bot/Crawler'")
BOTS_SQL = "|".join(usage.BOT_WORDS)


@query("drop_bots", covers="P12 F20", sql=f"""WITH a AS (SELECT event_id, [{', '.join("'" + a + "'" for a in AGENTS)}][event_id % 7 + 1] AS agent, [{', '.join(FAMILIES)}][event_id % 3 + 1] AS family,
 [{', '.join(KINDS)}][event_id % 4 + 1] AS kind, nullif(user_id, 3) AS user_id, event_id % 5 AS session_index FROM events)
SELECT agent, family, kind, count(*) AS events FROM a WHERE NOT regexp_matches(agent, '{BOTS_SQL}', 'i') AND coalesce(family, '') <> 'Robot/Spider' AND coalesce(kind, '') NOT IN ('Bot/Crawler', 'Robot') AND user_id IS NOT NULL AND session_index > 0 GROUP BY 1, 2, 3""")
def drop_bots(t):
    def pick(values, n):
        return F.element_at(F.array(*[F.expr(x) for x in values]), (F.col("event_id") % n + 1).cast("int"))

    a = t.events.select(pick([f"'{x}'" for x in AGENTS], 7).alias("agent"), pick(FAMILIES, 3).alias("family"), pick(KINDS, 4).alias("kind"),
                        F.nullif("user_id", F.lit(3)).alias("user_id"), (F.col("event_id") % 5).alias("session_index"))
    kept = usage.drop_bots(a, "agent", family="family", kind="kind", user="user_id", session_index="session_index")
    return kept.groupBy("agent", "family", "kind").agg(F.count("*").alias("events"))


ZONES = ("Asia/Calcutt", "America/New_York", "bad zone", "UTC", "EuropeALondon", "SystemV/EST5", "Asia%2FTokyo", "America/Argentina/Salta", "Europe/Zurich", "Europe/Zurich01' x",
         "Asia/Singaporen27lirczxx", "America/Coyhaique", "America/oastify-com", "Asia/Singapore", "America/New_York01ix691pvh")


@query("repair_zones", covers="P10", sql=f"""WITH a AS (SELECT [{', '.join("'" + a.replace("'", "''") + "'" for a in ZONES)}][event_id % {len(ZONES)} + 1] AS zone FROM events)
SELECT zone, CASE WHEN zone = 'Asia/Calcutt' THEN 'Asia/Calcutta' WHEN zone = 'EuropeALondon' THEN 'Europe/London' WHEN zone LIKE 'Asia/Singapore%' THEN 'Asia/Singapore' WHEN zone LIKE 'Europe/Zurich%' THEN 'Europe/Zurich'
 WHEN zone IN ('America/New_York', 'UTC', 'America/Argentina/Salta') THEN zone END AS repaired, count(*) AS events FROM a GROUP BY 1, 2""")
def repair_zones(t):
    z = F.element_at(F.array(*[F.lit(x) for x in ZONES]), (F.col("event_id") % len(ZONES) + 1).cast("int"))
    return t.events.select(z.alias("zone")).groupBy("zone", usage.repair_zone(F.col("zone")).alias("repaired")).agg(F.count("*").alias("events"))


@query("active_users_monthly", covers="P37 A04 T15 A15 A16", sql=f"""WITH e AS (SELECT *, CAST(date_trunc('month', ts) AS DATE) AS month, nullif(user_id % 40, 7) AS account, CASE WHEN event_type IN ('view', 'click') THEN 'browse' WHEN event_type IN ('signup', 'purchase') THEN 'convert' ELSE 'other' END AS stage,
 {K_SQL} % 3 = 0 AS paid FROM events WHERE CAST(ts AS DATE) >= last_day(CAST(ts AS DATE)) - INTERVAL 27 DAY),
p AS (SELECT month, account, arg_max(paid, (ts, event_type)) AS account_paid FROM e WHERE account IS NOT NULL GROUP BY 1, 2), j AS (SELECT * FROM e LEFT JOIN p USING (month, account)),
g AS (SELECT *, 'total' AS user_group FROM j UNION ALL SELECT *, CASE WHEN account_paid THEN 'paid' ELSE 'free' END FROM j WHERE account IS NOT NULL)
SELECT g.month, g.stage, user_group, count(*) AS event_count, count(DISTINCT account) AS account_count, count(DISTINCT user_id) AS user_count, any_value(names) AS event_names
FROM g JOIN (SELECT month, stage, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS names FROM e GROUP BY 1, 2) n ON g.month = n.month AND g.stage = n.stage GROUP BY 1, 2, 3""")
def active_users_monthly(t):
    e = t.events.withColumn("account", F.nullif(F.col("user_id") % 40, F.lit(7)))  # some events have no account
    stage = F.when(F.col("event_type").isin("view", "click"), "browse").when(F.col("event_type").isin("signup", "purchase"), "convert").otherwise("other")
    return usage.active_users(e, "user_id", "account", "ts", "event_type", stage, K() % 3 == 0)


METRICS = (("view", "browse", "read", False, True, True), ("click", "browse", "act", False, True, True), ("signup", "convert", "join", True, False, True),
           ("purchase", "convert", "join", False, True, True), ("error", "other", "fail", False, True, True))


@query("active_users_by_metric", covers="P37 A04 A15", sql=f"""WITH m(kind, stage, grp, umau, gmau, smau) AS (VALUES {', '.join(str(m) for m in METRICS)}),
w AS (SELECT stage FROM m WHERE smau GROUP BY 1 HAVING count(DISTINCT grp) > 1 OR count(DISTINCT gmau) > 1),
e AS (SELECT *, CAST(date_trunc('month', ts) AS DATE) AS month, nullif(user_id % 40, 7) AS account, {K_SQL} % 3 = 0 AS paid FROM events WHERE CAST(ts AS DATE) >= last_day(CAST(ts AS DATE)) - INTERVAL 27 DAY AND event_type IN (SELECT kind FROM m)),
p AS (SELECT month, account, arg_max(paid, (ts, event_type)) AS account_paid FROM e WHERE account IS NOT NULL GROUP BY 1, 2),
j AS (SELECT e.*, account_paid, m.stage, grp, umau, gmau, smau, m.stage IN (SELECT stage FROM w) AS over FROM e JOIN m ON event_type = kind LEFT JOIN p ON p.month = e.month AND p.account = e.account),
l AS (SELECT * REPLACE (smau AND NOT over AS smau) FROM j WHERE umau OR gmau OR (smau AND NOT over) UNION ALL SELECT * REPLACE (false AS gmau, NULL AS grp) FROM j WHERE over AND smau),
g AS (SELECT *, 'total' AS user_group FROM l UNION ALL SELECT *, CASE WHEN account_paid THEN 'paid' ELSE 'free' END FROM l WHERE account_paid IS NOT NULL)
SELECT month, umau, gmau, smau, stage, grp AS "group", user_group, count(*) AS event_count, count(DISTINCT account) AS account_count, count(DISTINCT user_id) AS user_count, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_names FROM g GROUP BY ALL""")
def active_users_by_metric(t):
    kinds = t.events.select(F.col("event_type").alias("kind")).distinct()
    row = lambda m: F.struct(*[F.lit(v).alias(n) for v, n in zip(m[1:], ("stage", "group", "umau", "gmau", "smau"))])
    meaning = F.coalesce(*[F.when(F.col("kind") == m[0], row(m)) for m in METRICS])
    metrics = kinds.select("kind", meaning.alias("m")).where("m is not null").select("kind", "m.*")
    e = t.events.withColumn("account", F.nullif(F.col("user_id") % 40, F.lit(7)))
    return usage.active_users_by_metric(e, metrics, "user_id", "account", "ts", "event_type", K() % 3 == 0)


@query("first_last_version", covers="P38 A13", sql=f"""SELECT event_type, min({K_SQL} % 17 * 100 + {K_SQL} % 13) AS first_version, max({K_SQL} % 17 * 100 + {K_SQL} % 13) AS last_version, true AS estimate_is_near FROM events GROUP BY 1""")
def first_last_version(t):
    """The approximate number of installs stands within 15 % of the exact one (three times its stated deviation)."""
    e = t.events.select("event_type", "user_id", F.concat((K() % 17).cast("string"), F.lit("."), (K() % 13).cast("string"), F.lit(".0")).alias("version"))
    exact = e.groupBy("event_type").agg(F.countDistinct("user_id").alias("installs"))
    near = F.abs(F.col("installs_estimate") - F.col("installs")) <= 0.15 * F.col("installs")
    return usage.first_last_version(e, "event_type", "version", "user_id").join(exact, "event_type").select("event_type", "first_version", "last_version", near.alias("estimate_is_near"))


@query("first_last_version_exact", covers="P38", sql=f"""SELECT event_type, min({K_SQL} % 17 * 100 + {K_SQL} % 13) AS first_version, max({K_SQL} % 17 * 100 + {K_SQL} % 13) AS last_version FROM events GROUP BY 1""")
def first_last_version_exact(t):
    return first_last_version(t).drop("estimate_is_near")


@query("usage_estimate", covers="P39", sql="""WITH u AS (SELECT c_mktsegment, c_nationkey % 3 <> 0 AS reporting, c_custkey % 50 + 1 AS seats, coalesce(n, 0) AS recorded FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey),
g AS (SELECT c_mktsegment, count(*) FILTER (reporting) AS reporting_count, count(*) FILTER (NOT reporting) AS not_reporting_count, CAST(sum(CASE WHEN reporting THEN seats ELSE 0 END) AS BIGINT) AS reporting_seats,
 CAST(sum(CASE WHEN NOT reporting THEN seats ELSE 0 END) AS BIGINT) AS not_reporting_seats, CAST(sum(CASE WHEN reporting THEN recorded ELSE 0 END) AS BIGINT) AS recorded FROM u GROUP BY 1)
SELECT c_mktsegment, recorded, reporting_count, reporting_seats, round(reporting_count / (reporting_count + not_reporting_count), 6) AS count_coverage, round(reporting_seats / (reporting_seats + not_reporting_seats), 6) AS seat_coverage,
 round(recorded / (reporting_count / (reporting_count + not_reporting_count)), 4) AS estimate_by_count, round(recorded / (reporting_seats / (reporting_seats + not_reporting_seats)), 4) AS estimate_by_seats FROM g""")
def usage_estimate(t):
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    u = t.customer.join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_mktsegment", (F.col("c_nationkey") % 3 != 0).alias("reporting"), (F.col("c_custkey") % 50 + 1).alias("seats"), F.coalesce("n", F.lit(0)).alias("recorded"))
    e = usage.usage_estimate(u, ["c_mktsegment"], "reporting", "seats", "recorded")
    return e.select("c_mktsegment", "recorded", "reporting_count", "reporting_seats", F.round("count_coverage", 6).alias("count_coverage"), F.round("seat_coverage", 6).alias("seat_coverage"),
                    r4("estimate_by_count").alias("estimate_by_count"), r4("estimate_by_seats").alias("estimate_by_seats"))


@query("monthly_delta", covers="P40", sql="""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, CAST(round(max(value) * 100) AS BIGINT) AS counter FROM events GROUP BY 1, 2)
SELECT *, greatest(counter - coalesce(lag(counter) OVER (PARTITION BY user_id ORDER BY day), 0), 0) AS counter_delta FROM d""")
def monthly_delta(t):
    d = t.events.groupBy("user_id", i.day("ts").alias("day")).agg(F.round(F.max("value") * 100).cast("long").alias("counter"))
    return usage.monthly_delta(d, ["user_id"], "day", "counter")


@query("running_totals", covers="P41 W10 W12", sql="""WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS events, round(sum(value), 2) AS value FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, day, events, CAST(sum(events) OVER w AS BIGINT) AS events_to_date, round(sum(value) OVER w, 2) AS value_to_date FROM d WINDOW w AS (PARTITION BY user_id, event_type ORDER BY day ROWS UNBOUNDED PRECEDING)""")
def running_totals(t):
    d = t.events.groupBy("user_id", "event_type", i.day("ts").alias("day")).agg(F.count("*").alias("events"), r2(F.sum("value")).alias("value"))
    out = usage.running_total(d, ["user_id", "event_type"], ["day"], None, ["events", "value"])
    return out.withColumn("value_to_date", r2("value_to_date")).drop("value")


@query("running_event_value", covers="W10 P41", sql="""SELECT event_id, user_id, row_number() OVER w AS position, round(sum(value) OVER w, 2) AS value_so_far FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_event_value(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    out = ordered.with_running_sum(e, ["user_id"], ["ts", "event_id"], None, {"position": F.lit(1).cast("long"), "value_so_far": "value"})
    return out.select("event_id", "user_id", "position", r2("value_so_far").alias("value_so_far"))


STEPS = ["signup", "view", "click", "purchase"]


@query("funnel", covers="P45a", sql="""WITH g AS (SELECT user_id, max(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END) AS max_step,
 min(ts) FILTER (event_type = 'signup') AS signup_at, min(ts) FILTER (event_type = 'view') AS view_at, min(ts) FILTER (event_type = 'click') AS click_at, min(ts) FILTER (event_type = 'purchase') AS purchase_at FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT *, CASE WHEN signup_at <= view_at AND view_at <= click_at AND click_at <= purchase_at THEN 4 WHEN signup_at <= view_at AND view_at <= click_at THEN 3 WHEN signup_at <= view_at THEN 2 WHEN signup_at IS NOT NULL THEN 1 ELSE 0 END AS steps_in_order FROM g""")
def funnel(t):
    return usage.funnel_base(t.events, "user_id", "event_type", "ts", STEPS)


@query("outcome_precedence", covers="P45a J18", sql="""WITH o AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events)
SELECT concat(user_id, ':', day) AS item, CASE WHEN bool_or(event_type = 'purchase') THEN 'purchase' WHEN bool_or(event_type = 'error') THEN 'error' ELSE 'view' END AS outcome FROM o WHERE event_type IN ('purchase', 'error', 'view') GROUP BY 1""")
def outcome_precedence(t):
    e = t.events.select(F.concat(F.col("user_id").cast("string"), F.lit(":"), i.day("ts").cast("string")).alias("item"), "event_type")
    return usage.outcome_with_precedence(e, "item", "event_type", ["purchase", "error", "view"])


@query("activation", covers="P46a", sql="""WITH g AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS created_at, min(ts) FILTER (event_type = 'view') AS view_at, min(ts) FILTER (event_type = 'purchase') AS purchase_at FROM events GROUP BY 1),
m AS (SELECT *, date_diff('minute', created_at, view_at) AS minutes_to_view, date_diff('minute', created_at, purchase_at) AS minutes_to_purchase FROM g)
SELECT *, CASE WHEN minutes_to_purchase IS NULL THEN 'never' WHEN minutes_to_purchase < 0 THEN 'before creation' WHEN minutes_to_purchase <= 60 THEN 'fast' WHEN minutes_to_purchase <= 1440 THEN 'normal' ELSE 'slow' END AS activation_class FROM m""")
def activation(t):
    return usage.activation(t.events, "user_id", "event_type", "ts", "signup", ["view", "purchase"], 60, 1440)


@query("first_last_attributes", covers="P47a W08 W09", sql=f"""SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_max(event_type, (ts, event_id)) AS last_event_type,
 arg_min(CASE WHEN {K_SQL} % 2 = 0 THEN {K_SQL} END, CASE WHEN {K_SQL} % 2 = 0 THEN (ts, event_id) END) AS first_k, arg_max(CASE WHEN {K_SQL} % 2 = 0 THEN {K_SQL} END, CASE WHEN {K_SQL} % 2 = 0 THEN (ts, event_id) END) AS last_k FROM events GROUP BY 1""")
def first_last_attributes(t):
    e = t.events.select("user_id", "ts", "event_id", "event_type", F.when(K() % 2 == 0, K()).alias("k"))
    return usage.first_last_attributes(e, "user_id", ["ts", "event_id"], ["event_type", "k"])


SQL_CUSTOMER_RATIOS = """u AS (SELECT c_custkey, CAST(date_diff('month', min(o_orderdate), DATE '2001-12-31') AS INTEGER) % 15 AS age_months, count(*) FILTER (o_orderstatus = 'F') / count(*) AS license_use,
 count(*) FILTER (o_orderstatus = 'O') / count(*) AS engagement, count(DISTINCT date_trunc('month', o_orderdate)) / 20 AS activity FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1)"""


@query("health_score", covers="P68", sql=f"""WITH {SQL_CUSTOMER_RATIOS}, s AS (SELECT *, CASE WHEN age_months < 3 THEN NULL WHEN age_months < 7 THEN CASE WHEN license_use <= 0.1 THEN 25 WHEN license_use <= 0.5 THEN 63 ELSE 88 END
 WHEN age_months < 10 THEN CASE WHEN license_use <= 0.5 THEN 25 WHEN license_use <= 0.75 THEN 63 ELSE 88 END ELSE CASE WHEN license_use <= 0.75 THEN 25 ELSE 88 END END AS license_use_score,
 CASE WHEN engagement < 0.5 THEN 25 WHEN engagement < 0.8 THEN 63 ELSE 88 END AS engagement_score, CASE WHEN activity <= 0.1 THEN 25 WHEN activity <= 0.33 THEN 63 ELSE 88 END AS activity_score FROM u)
SELECT c_custkey, license_use_score, engagement_score, activity_score, CASE license_use_score WHEN 25 THEN 'Red' WHEN 63 THEN 'Yellow' WHEN 88 THEN 'Green' END AS license_use_color,
 round((coalesce(license_use_score * 0.5, 0) + engagement_score * 0.3 + activity_score * 0.2) / (CASE WHEN license_use_score IS NULL THEN 0 ELSE 0.5 END + 0.3 + 0.2), 4) AS overall_score FROM s""")
def health_score(t):
    from tidemark.functions.scalars import boundary_diff
    g = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_custkey").agg(
        F.min("o_orderdate").alias("first"), F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("o"), F.countDistinct(F.trunc("o_orderdate", "month")).alias("m"))
    u = g.select("c_custkey", (boundary_diff("month", F.col("first"), F.lit(i.ORDERS_AS_OF)) % 15).alias("age_months"),
                 (F.col("f") / F.col("n")).alias("license_use"), (F.col("o") / F.col("n")).alias("engagement"), (F.col("m") / 20).alias("activity"))
    s = usage.health_score(u, "age_months", "license_use", [(3, 7, .1, .5), (7, 10, .5, .75), (10, None, .75, None)],
                           {"engagement": (.5, .8, True), "activity": (.1, .33)}, {"license_use": .5, "engagement": .3, "activity": .2})
    return s.select("c_custkey", "license_use_score", "engagement_score", "activity_score", "license_use_color", r4("overall_score").alias("overall_score"))


@query("license_utilization", covers="P73 F13 J17", sql="""WITH u AS (SELECT o_custkey AS subscription, CAST(o_orderdate AS DATE) AS day, o_orderkey AS instance, CAST(sum(l_quantity) AS BIGINT) AS users, CAST(sum(l_quantity) AS BIGINT) - 50 AS licensed,
 CASE WHEN o_orderkey % 4 = 0 THEN 'Staging' ELSE 'Production' END AS kind FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
tr AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN 'Pro' ELSE 'Enterprise' END AS product, DATE '1996-01-01' + CAST(c_custkey % 700 AS INTEGER) AS a, DATE '1996-01-01' + CAST(c_custkey % 700 + 400 AS INTEGER) AS b FROM customer WHERE c_custkey % 3 = 0),
ti AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 7 < 3 THEN 'Pro' ELSE 'Enterprise' END AS product, CAST(o_orderdate AS DATE) - 10 AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) - 15 AS b FROM orders WHERE o_orderkey % 5 = 0)
SELECT subscription, day, instance, users, licensed, kind,
 licensed > 0 AND (EXISTS (SELECT 1 FROM tr WHERE key = subscription AND product = 'Pro' AND day BETWEEN a AND b) OR EXISTS (SELECT 1 FROM ti WHERE key = instance AND product = 'Pro' AND day BETWEEN a AND b)) AS is_pro_trial,
 licensed > 0 AND (EXISTS (SELECT 1 FROM tr WHERE key = subscription AND product = 'Enterprise' AND day BETWEEN a AND b) OR EXISTS (SELECT 1 FROM ti WHERE key = instance AND product = 'Enterprise' AND day BETWEEN a AND b)) AS is_enterprise_trial,
 kind = 'Production' AND row_number() OVER (PARTITION BY subscription, day ORDER BY users DESC NULLS LAST, instance DESC) = 1 AS is_max_instance FROM u""")
def license_utilization(t):
    """Two trial products, each by subscription and by instance; instances that aren't in production."""
    k, c, d = F.col("o_orderkey"), F.col("c_custkey"), i.day("o_orderdate")
    u = t.orders.join(t.lineitem, F.col("l_orderkey") == k).groupBy(F.col("o_custkey").alias("subscription"), d.alias("day"), k.alias("instance")).agg(F.sum("l_quantity").cast("long").alias("users"))
    u = u.select("*", (F.col("users") - 50).alias("licensed"), F.when(F.col("instance") % 4 == 0, "Staging").otherwise("Production").alias("kind"))
    base = F.lit(dt.date(1996, 1, 1))
    by_subscription = t.customer.where(c % 3 == 0).select(c.alias("subscription"), F.when(c % 2 == 0, "Pro").otherwise("Enterprise").alias("product"),
                                                          F.date_add(base, (c % 700).cast("int")).alias("start"), F.date_add(base, (c % 700 + 400).cast("int")).alias("end"))
    by_instance = t.orders.where(k % 5 == 0).select(k.alias("instance"), F.when(k % 7 < 3, "Pro").otherwise("Enterprise").alias("product"),
                                                    F.date_sub(d, 10).alias("start"), F.date_add(d, (k % 20 - 15).cast("int")).alias("end"))
    return usage.license_utilization(u, "subscription", "day", "instance", "users", "licensed", "kind",
                                     [(by_subscription, "subscription"), (by_instance, "instance")], {"pro": "Pro", "enterprise": "Enterprise"})


SQL_TRAILING = """d AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id, value FROM events), e AS (SELECT DISTINCT event_type, day FROM d)"""


@query("trailing_active_users", covers="T15 A04 W16", sql=f"""WITH {SQL_TRAILING}
SELECT e.event_type, e.day, count(DISTINCT user_id) AS active_users FROM e JOIN d ON d.event_type = e.event_type AND d.day BETWEEN e.day - 27 AND e.day GROUP BY 1, 2""")
def trailing_active_users(t):
    return usage.trailing_active_users(t.events, ["event_type"], "user_id", "ts")


@query("trailing_sketches", covers="A12 A13 P38", sql=f"""WITH {SQL_TRAILING}
SELECT e.event_type, e.day, count(DISTINCT d.day) AS days, count(*) AS n, true AS users_are_near, true AS median_is_near, true AS p90_is_near FROM e JOIN d ON d.event_type = e.event_type AND d.day BETWEEN e.day - 27 AND e.day GROUP BY 1, 2""")
def trailing_sketches(t):
    """28-day estimates from stored daily sketches, held against the exact ones: five standard errors of the distinct count, twice the rank error of a quantile."""
    path = f"{shared_dir(t.spark)}/sketches-{uuid.uuid4().hex[:8]}"
    e = t.events.select("event_type", "user_id", i.day("ts").alias("day"), "value")
    sketches.daily(e, ["event_type"], "day", "user_id", "value").write.parquet(path)
    probs = {"median": 0.5, "p90": 0.9}
    got = sketches.trailing(t.spark.read.parquet(path), ["event_type"], "day", 28, probs)
    exact = usage.trailing_active_users(t.events, ["event_type"], "user_id", "ts")
    off = 2 * sketches.rank_error()
    ends = e.select("event_type", F.col("day").alias("end")).distinct()
    reach = e.select("event_type", "value", F.explode(F.sequence(F.lit(0), F.lit(27))).alias("ahead"), "day").withColumn("end", F.date_add("day", F.col("ahead")))
    ranked = reach.join(ends, ["event_type", "end"], "left_semi").join(got.select("event_type", F.col("day").alias("end"), *probs), ["event_type", "end"])
    share = lambda x: F.avg(x.cast("double"))
    ranked = ranked.groupBy("event_type", F.col("end").alias("day")).agg(
        *[share(F.col("value") < F.col(n)).alias(f"{n}_below") for n in probs], *[share(F.col("value") <= F.col(n)).alias(f"{n}_upto") for n in probs])
    near = got.join(exact, ["event_type", "day"]).join(ranked, ["event_type", "day"])
    fits = lambda n, p: (F.col(f"{n}_below") <= p + off + 1 / F.col("n")) & (F.col(f"{n}_upto") >= p - off - 1 / F.col("n"))
    return near.select("event_type", "day", "days", "n", (F.abs(F.col("items_estimate") - F.col("active_users")) <= 1 + 0.041 * F.col("active_users")).alias("users_are_near"),
                       *[fits(n, p).alias(f"{n}_is_near") for n, p in probs.items()])


@query("storage_allowance", covers="P74a W13", sql="""WITH p AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS size, 30 AS free_limit, CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE 20 END AS bought FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, NOT (size < free_limit OR free_limit = 0) AS up, CASE WHEN size < free_limit OR free_limit = 0 OR bought = 0 THEN size ELSE free_limit END AS free_storage FROM p),
w AS (SELECT *, size - free_storage AS paid_storage, sum(size - free_storage) OVER (PARTITION BY l_orderkey) AS total_paid_storage FROM s)
SELECT l_orderkey, l_partkey, free_storage, paid_storage, total_paid_storage, up AND (bought = 0 OR total_paid_storage >= bought) AS is_capped FROM w""")
def storage_allowance(t):
    p = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("size")).withColumn("free_limit", F.lit(30.0)).withColumn(
        "bought", F.when(F.col("l_orderkey") % 5 == 0, 0).otherwise(20))
    s = usage.storage_allowance(p, ["l_orderkey"], "size", "free_limit", "bought")
    return s.select("l_orderkey", "l_partkey", "free_storage", "paid_storage", "total_paid_storage", "is_capped")


@query("quota_usage", covers="P100 F05 F06", sql="""WITH u AS (SELECT o_custkey AS account_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(l_quantity) AS used, CASE WHEN o_custkey % 9 = 0 THEN 0.0 ELSE 100.0 END AS allowance, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 20 END AS purchased, o_custkey % 7 <> 0 AS enabled
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL), s AS (SELECT *, CASE WHEN purchased = 0 OR used < allowance THEN 0 ELSE used - allowance END AS purchased_used, enabled AND allowance <> 0 AS limit_enabled FROM u)
SELECT account_id, month, used, purchased_used, used - purchased_used AS monthly_used, CASE WHEN limit_enabled THEN CAST(allowance AS VARCHAR) WHEN allowance = 0 THEN 'Unlimited' ELSE 'Not supported' END AS limit_label,
 CASE WHEN NOT limit_enabled THEN 'Disabled' WHEN used - purchased_used < allowance THEN 'Under Quota' ELSE 'Over Quota' END AS status, CASE WHEN purchased_used <= purchased OR NOT limit_enabled THEN 'Under Quota' ELSE 'Over Quota' END AS status_purchased FROM s""")
def quota_usage(t):
    a = F.col("account_id")
    u = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("account_id"), i.month("o_orderdate").alias("month")).agg(F.sum("l_quantity").alias("used"))
    u = u.select("*", F.when(a % 9 == 0, F.lit(0).cast("decimal(4,1)")).otherwise(F.lit(100).cast("decimal(4,1)")).alias("allowance"), F.when(a % 2 == 0, 0).otherwise(20).alias("purchased"), (a % 7 != 0).alias("enabled"))
    q = usage.quota_usage(u, "used", "allowance", "purchased", "enabled")
    return q.select("account_id", "month", "used", "purchased_used", "monthly_used", "limit_label", "status", "status_purchased")


@query("peak_rate", covers="P101 T14", sql="""WITH m AS (SELECT date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY 1) SELECT CAST(m AS DATE) AS day, max(n) AS peak, CAST(sum(n) AS BIGINT) AS total FROM m GROUP BY 1""")
def peak_rate(t):
    return usage.peak_rate(t.events, "ts", "minute", "day")


STAGES = ("view", "click", "signup", "purchase", "error")
SQL_MATRIX = ", ".join(f"count(DISTINCT CASE WHEN stage = '{k}' AND frame = '{f}' THEN user_id END) AS {k}_{f}" for k in STAGES for f in ("week", "month"))
SQL_WEEK = " + ".join(f"{k}_week" for k in STAGES)


@query("feature_matrix", covers="P102 A05 A24", sql=f"""WITH e AS (SELECT user_id % 20 AS account, user_id, event_type AS stage, CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN 'week' ELSE 'month' END AS frame FROM events),
g AS (SELECT account, {SQL_MATRIX} FROM e GROUP BY 1)
SELECT *, {', '.join(f"CASE WHEN {SQL_WEEK} = 0 THEN 0 ELSE round({k}_week / ({SQL_WEEK}), 6) END AS {k}_week_share" for k in STAGES)} FROM g""")
def feature_matrix(t):
    e = t.events.select((F.col("user_id") % 20).alias("account"), "user_id", F.col("event_type").alias("stage"),
                        F.when(F.col("ts") >= F.expr("timestamp_ntz'2024-01-24'"), "week").otherwise("month").alias("frame"))
    m = usage.feature_matrix(e, ["account"], "stage", "frame", "user_id", list(STAGES), ["week", "month"])
    return m.select("account", *[f"{k}_{f}" for k in STAGES for f in ("week", "month")], *[F.round(f"{k}_week_share", 6).alias(f"{k}_week_share") for k in STAGES])


@query("weighted_usage_share", covers="P103 W14", sql="""WITH g AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag, sum(l_quantity * CASE l_linestatus WHEN 'F' THEN 0.5 ELSE 2.0 END) AS weighted, sum(l_extendedprice) AS cost FROM lineitem GROUP BY 1, 2)
SELECT month, l_returnflag, weighted, round(cost, 2) AS cost, round(weighted / sum(weighted) OVER (PARTITION BY month), 6) AS share, round(cost / weighted, 4) AS cost_per_unit FROM g""")
def weighted_usage_share(t):
    li = t.lineitem.withColumn("month", i.month("l_shipdate"))
    w = usage.weighted_usage_share(li, "month", ["l_returnflag"], "l_quantity", F.when(F.col("l_linestatus") == "F", 0.5).otherwise(2.0), "l_extendedprice")
    return w.select("month", "l_returnflag", "weighted", r2("cost").alias("cost"), F.round("share", 6).alias("share"), r4("cost_per_unit").alias("cost_per_unit"))


@query("campaign_metrics", covers="P114", sql="""SELECT user_id % 10 AS campaign, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS total_view, count(DISTINCT user_id) FILTER (event_type = 'view') AS unique_view,
 count(*) FILTER (event_type = 'click') AS total_click, count(DISTINCT user_id) FILTER (event_type = 'click') AS unique_click FROM events WHERE event_type IN ('view', 'click') GROUP BY 1, 2""")
def campaign_metrics(t):
    return usage.campaign_metrics(t.events.withColumn("campaign", F.col("user_id") % 10), "campaign", "ts", "event_type", "user_id", ["view", "click"])


@query("collaboration_count", covers="P111 A09 A10", sql="""WITH p AS (SELECT l_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT s_nationkey) AS groups FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT month, round(avg(groups), 6) AS mean_groups, count(*) AS items, CAST(median(groups) AS DOUBLE) AS median_groups FROM p GROUP BY 1""")
def collaboration_count(t):
    j = i.order_lines(t).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    c = usage.collaboration_count(j.select("l_orderkey", i.month("o_orderdate").alias("month"), "s_nationkey"), "l_orderkey", "month", "s_nationkey")
    return c.withColumn("mean_groups", F.round("mean_groups", 6))


@query("first_engagement", covers="P78 T07", sql="""WITH r AS (SELECT conv_id, turn AS asked FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn, length(text) AS chars FROM conversations WHERE role = 'assistant')
SELECT r.conv_id, r.asked, min(a.turn) AS answered FROM r LEFT JOIN a ON a.conv_id = r.conv_id AND a.turn >= r.asked GROUP BY 1, 2""")
def first_engagement(t):
    c = t.conversations
    r = c.where(F.col("role") == "user").select("conv_id", F.col("turn").alias("at"))
    a = c.where(F.col("role") == "assistant").select("conv_id", F.col("turn").alias("at"), F.length("text").alias("chars"))
    m = history.next_match(r, a, ["conv_id"], "at", ["chars"])
    return m.select("conv_id", F.col("at").alias("asked"), F.col("matched_at").alias("answered")).distinct()
