"""Product usage: page views, sessions, active users, counters, funnels, health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import boundary_diff, div0, least_or_null, ratio, surrogate_key
from tidemark.operators import bitmaps, ordered
from tidemark.operators.intervals import points_in
from tidemark.operators.keys import latest_per_key

# Repaired and rejected spellings of a browser's time zone.
ZONE_REPAIRS = {
    "America/A": None,
    "America/Buenos_Airesnos_Aires": "America/Buenos_Aires",
    "America/Coyhaique": None,
    "America/New_York01ix691pvh": None,
    "Asia/Calcutt": "Asia/Calcutta",
    "Asia/Rangoo": "Asia/Rangoon",
    "Asia/SaigonMinh": "Asia/Ho_Chi_Minh",
    "Asia/Shangh": "Asia/Shanghai",
    "Asia/Singaporegpad8vnkdm": "Asia/Singapore",
    "Asia/Singaporen27lirczxx": "Asia/Singapore",
    "Asia/Singaporere6mvs9sb0": "Asia/Singapore",
    "Etc/Unknown": None,
    "EuropeALondon": "Europe/London",
    "SystemV/CST6": None,
    "SystemV/EST5": None,
    "SystemV/HST10": None,
    "SystemV/MST7": None,
    "UTC": "UTC",
}
# What a zone starts with and is cut to, and what no zone may hold.
ZONE_PREFIX = "Europe/Zurich"
ZONE_JUNK = "oastify.com"

# Words of a user agent that mark a bot.
BOT_WORDS = ("bot", "crawl", "slurp", "spider", "archiv", "spinn", "sniff", "seo", "audit", "survey", "pingdom", "worm", "capture",
             "browsershots", "screenshots", "analyz", "index", "thumb", "check", "facebook", "phantomjs", "a_archiver",
             "facebookexternalhit", "bingpreview", "360user-agent", "semalt")
# Browser family and types that mark one.
BOT_FAMILY = "Robot/Spider"
BOT_TYPES = ("Bot/Crawler", "Robot")


def repair_zone(zone: Column) -> Column:
    """Known spellings repaired, a known prefix cut off from what follows it, known junk and anything that is no Area/City name dropped."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for wrong, right in ZONE_REPAIRS.items():
        out = out.when(zone == wrong, F.lit(right).cast("string"))
    out = out.when(zone.rlike(ZONE_JUNK), F.lit(None).cast("string")).when(F.startswith(zone, F.lit(ZONE_PREFIX)), F.lit(ZONE_PREFIX))
    shape = zone.rlike(r"^[A-Za-z0-9_+-]+/[A-Za-z0-9_+-]+(/[A-Za-z0-9_+-]+)*$")
    return F.replace(out.when(~shape, F.lit(None).cast("string")).otherwise(zone), F.lit("%2F"), F.lit("/"))


def drop_bots(df: DataFrame, agent: str, words: Sequence[str] = BOT_WORDS, family: str | None = None, kind: str | None = None,
              user: str | None = None, session_index: str | None = None) -> DataFrame:
    """Rows whose user agent holds none of the bot words; a NULL agent stays.

    Where the columns are given: a browser ``family`` or ``kind`` of a robot goes (NULL stays), and so does a row without
    ``user`` or without a positive ``session_index``.
    """
    pattern = "(?i)(" + "|".join(words) + ")"
    keep = F.col(agent).isNull() | ~F.col(agent).rlike(pattern)
    if family:
        keep &= F.col(family).isNull() | (F.col(family) != BOT_FAMILY)
    if kind:
        keep &= F.col(kind).isNull() | ~F.col(kind).isin(*BOT_TYPES)
    if user:
        keep &= F.col(user).isNotNull()
    if session_index:
        keep &= F.coalesce(F.col(session_index).try_cast("int") > 0, F.lit(False))
    return df.where(keep)


def sessionize(events: DataFrame, user: str, ts: str, tie: str, minutes: int = 30) -> DataFrame:
    """Session number per user; a gap of more than ``minutes`` opens a new one.

    The previous time and the count are carried over ranges of a very active user, who is spread by volume.
    """
    gap = lambda prev: F.timestamp_diff("MICROSECOND", prev["ts"], F.col(ts)) > minutes * 60_000_000
    return ordered.with_islands(events, [user], [ts, tie], None, {"ts": ts}, gap, "session_index")


def page_views(events: DataFrame, page: str, kind: str, ts: str, width: str, height: str, x: str, y: str,
               attrs: Sequence[str], ping_seconds: int = 30) -> DataFrame:
    """One row per page id from its view and its pings.

    Attributes are those of the first view; each ping stands for ``ping_seconds`` of engagement; scroll depth is the
    range of offsets, clipped to the document, as a share of its size.
    """
    is_view = F.col(kind) == "page_view"
    w = F.when((F.col(width) != 0) & (F.col(height) != 0), F.col(width))
    h = F.when((F.col(width) != 0) & (F.col(height) != 0), F.col(height))
    tie = F.struct(ts, *attrs)
    g = events.groupBy(page).agg(
        F.min_by(F.struct(*attrs), F.when(is_view, tie)).alias("__first"),
        F.min(ts).alias("page_view_start"), F.max(ts).alias("page_view_end"),
        F.count_if(is_view).alias("page_view_count"), F.count_if(F.col(kind) == "page_ping").alias("page_ping_count"),
        F.max(w).alias("document_width"), F.max(h).alias("document_height"),
        F.min(F.coalesce(x, F.lit(0))).alias("__x0"), F.max(F.coalesce(x, F.lit(0))).alias("__x1"),
        F.min(F.coalesce(y, F.lit(0))).alias("__y0"), F.max(F.coalesce(y, F.lit(0))).alias("__y1"),
    )

    def clip(v: str, size: str) -> Column:
        return least_or_null(F.greatest(F.col(v), F.lit(0)), size)

    def depth(hi: Column, size: str) -> Column:
        return F.round(100 * ratio(hi, size))

    g = g.withColumns({"scroll_x_max": clip("__x1", "document_width"), "scroll_y_max": clip("__y1", "document_height"),
                       "scroll_x_min": clip("__x0", "document_width"), "scroll_y_min": clip("__y0", "document_height")})
    engaged = F.col("page_ping_count") * ping_seconds
    return g.where(F.col("page_view_count") > 0).select(
        page, "__first.*", "page_view_start", "page_view_end", "page_view_count", "page_ping_count",
        engaged.alias("time_engaged_in_s"), "document_width", "document_height",
        "scroll_x_min", "scroll_x_max", "scroll_y_min", "scroll_y_max",
        depth(F.col("scroll_x_max"), "document_width").alias("horizontal_percentage_scrolled"),
        depth(F.col("scroll_y_max"), "document_height").alias("vertical_percentage_scrolled"),
        ((engaged >= 30) & (F.coalesce(depth(F.col("scroll_y_max"), "document_height"), F.lit(0)) >= 25)).alias("user_engaged"),
    )


def with_last_in_session(views: DataFrame, session: Sequence[str], start: str, page: str) -> DataFrame:
    """Flag of the session's last page view, through an aggregate joined back."""
    last = views.groupBy(*session).agg(F.max_by(page, F.struct(start, page)).alias("__last"))
    return views.join(last, list(session), "left").withColumn("last_page_view_in_session", (F.col("__last") == F.col(page)).cast("int")).drop("__last")


def engaged_tier(seconds: Column) -> Column:
    return (
        F.when(seconds.between(0, 9), "0s to 9s").when(seconds.between(10, 29), "10s to 29s")
        .when(seconds.between(30, 59), "30s to 59s").when(seconds.between(60, 119), "60s to 119s")
        .when(seconds.between(120, 239), "120s to 239s").when(seconds > 239, "240s or more")
    )


def sessions(views: DataFrame, user: str, session: str, page: str, start: str, end: str, engaged: str, seconds: str,
             attrs: Sequence[str]) -> DataFrame:
    """One row per session: first and last attributes, counts, tier, bounce and engagement flags."""
    first, last = F.struct(start, page), F.struct(end, page)
    g = views.groupBy(user, session).agg(
        F.min(start).alias("session_start"), F.max(end).alias("session_end"), F.count("*").alias("page_views"),
        F.count_if(F.col(engaged)).alias("engaged_page_views"), F.sum(seconds).alias("time_engaged_in_s"),
        *[F.min_by(a, first).alias(f"first_{a}") for a in attrs], *[F.max_by(a, last).alias(f"last_{a}") for a in attrs],
    )
    busy = (F.col("page_views") > 2) & (F.col("time_engaged_in_s") > 59)
    return g.select(
        "*", engaged_tier(F.col("time_engaged_in_s")).alias("time_engaged_in_s_tier"),
        (F.col("page_views") == 1).alias("user_bounced"), (busy | (F.col("engaged_page_views") > 0)).alias("user_engaged"),
    )


def active_users(events: DataFrame, user: str, account: str, ts: str, kind: str, stage: Column, paid: Column,
                 window_days: int = 28) -> DataFrame:
    """Distinct users and accounts per month and stage in the month's last ``window_days``, as total, free and paid.

    An account's plan is the one at its last event of the month. Rows are first folded to one per user, account and
    stage in a month, so the distinct counts work on the folded rows; the three user groups come from one pass. Events without
    an account count in the total only.
    """
    day = F.to_date(F.col(ts))
    last_day = F.last_day(day)
    e = events.where(day >= F.date_sub(last_day, window_days - 1)).select(
        F.trunc(day, "month").alias("month"), F.col(user).alias("user"), F.col(account).alias("account"), F.col(ts).alias("ts"),
        F.col(kind).alias("kind"), stage.alias("stage"), paid.alias("paid"))
    folded = e.groupBy("month", "stage", "account", "user").agg(F.count("*").alias("n"))
    plan = e.where(F.col("account").isNotNull()).groupBy("month", "account").agg(F.coalesce(F.max_by("paid", F.struct("ts", "kind")), F.lit(False)).alias("paid"))
    rows = folded.join(plan, ["month", "account"], "left")
    groups = F.explode(F.array_compact(F.array(F.lit("total"), F.when(F.col("paid"), "paid").when(~F.col("paid"), "free"))))
    names = e.groupBy("month", "stage").agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("event_names"))
    return rows.select("*", groups.alias("user_group")).groupBy("month", "stage", "user_group").agg(
        F.sum("n").alias("event_count"), F.countDistinct("account").alias("account_count"), F.countDistinct("user").alias("user_count"),
    ).join(names, ["month", "stage"])


def stages_over_groups(metrics: DataFrame) -> DataFrame:
    """Stages whose stage metric spans several groups, or mixes events that do and don't count for a group."""
    own = metrics.where("smau").groupBy("stage").agg(F.countDistinct("group").alias("groups"), F.countDistinct("gmau").alias("flags"))
    return own.where("groups > 1 or flags > 1").select("stage")


def active_users_by_metric(events: DataFrame, metrics: DataFrame, user: str, account: str, ts: str, kind: str, paid: Column,
                           window_days: int = 28) -> DataFrame:
    """Active users per month and metric level (``umau``, ``gmau``, ``smau``, stage, group), as total, free and paid.

    ``metrics`` has a row per event name (``kind, stage, group, umau, gmau, smau``). Where a stage metric spans several groups, its
    events count once more for the stage as a whole, without group, and no longer for it at group level. Events of the
    month's last ``window_days`` count; an account's plan is the one at its last event of the month, and events without an account count in
    the total only.
    """
    day = F.to_date(F.col(ts))
    named = metrics.select(F.col("kind").alias("__kind"), "stage", "group", "umau", "gmau", "smau").where("umau or gmau or smau")
    wide = stages_over_groups(metrics).select(F.col("stage").alias("__wide"))
    levels = named.join(wide, F.col("stage") == F.col("__wide"), "left")
    over = F.col("__wide").isNotNull()
    level = lambda gmau, smau, group: F.struct(gmau.alias("gmau"), smau.alias("smau"), group.alias("group"))
    own = F.when(F.col("umau") | F.col("gmau") | (F.col("smau") & ~over), level(F.col("gmau"), F.col("smau") & ~over, F.col("group")))
    whole = F.when(over & F.col("smau"), level(F.lit(False), F.lit(True), F.lit(None).cast(metrics.schema["group"].dataType)))
    levels = levels.select("__kind", "stage", "umau", F.explode(F.array_compact(F.array(own, whole))).alias("__l")).select("__kind", "stage", "umau", "__l.*")

    e = events.where(day >= F.date_sub(F.last_day(day), window_days - 1)).select(
        F.trunc(day, "month").alias("month"), F.col(user).alias("user"), F.col(account).alias("account"), F.col(ts).alias("ts"), F.col(kind).alias("kind"), paid.alias("paid"))
    e = e.join(named.select("__kind"), F.col("kind") == F.col("__kind"), "left_semi").where(F.col("user").isNotNull())
    plan = e.where(F.col("account").isNotNull()).groupBy("month", "account").agg(F.max_by("paid", F.struct("ts", "kind")).alias("paid"))
    folded = e.groupBy("month", "kind", "account", "user").agg(F.count("*").alias("n")).join(plan, ["month", "account"], "left")
    folded = folded.withColumn("plan", F.when(F.col("paid"), "paid").when(~F.col("paid"), "free"))
    # one table of bitmaps by month, event and plan; every level and user group is a union of some of its rows
    who = bitmaps.table(bitmaps.numbered(folded, "user"), ["month", "kind", "plan"], "number").withColumn("of", F.lit("user"))
    what = bitmaps.table(bitmaps.numbered(folded.where(F.col("account").isNotNull()), "account"), ["month", "kind", "plan"], "number").withColumn("of", F.lit("account"))
    groups = F.explode(F.array_compact(F.array(F.lit("total"), F.col("plan")))).alias("user_group")
    by = ["month", "umau", "gmau", "smau", "stage", "group", "user_group"]

    def on_levels(df: DataFrame) -> DataFrame:
        return df.join(levels, F.col("kind") == F.col("__kind")).select("*", groups)

    counts = bitmaps.counted(on_levels(who.unionByName(what)), [*by, "of"], "n")
    # levels may have NULL parts: a struct is equal to another where all parts are
    counts = counts.groupBy(F.struct(*by).alias("__by")).agg(
        F.coalesce(F.max(F.when(F.col("of") == "account", F.col("n"))), F.lit(0)).alias("account_count"), F.max(F.when(F.col("of") == "user", F.col("n"))).alias("user_count"))
    events_of = on_levels(folded.groupBy("month", "kind", "plan").agg(F.sum("n").alias("n"))).groupBy(F.struct(*by).alias("__by")).agg(
        F.sum("n").alias("event_count"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("event_names"))
    return events_of.join(counts, "__by").select("__by.*", "event_count", "account_count", "user_count", "event_names")


def trailing_active_users(events: DataFrame, keys: Sequence[str], user: str, ts: str, window_days: int = 28) -> DataFrame:
    """Distinct users of the ``window_days`` days that end with each day, exactly, for every day on which ``keys`` have an event.

    Users are set in one bitmap per day; a day's window is the union of its days' bitmaps, so no user is counted or moved more than once.
    """
    day = F.to_date(F.col(ts)).alias("day")
    e = bitmaps.numbered(events.select(*keys, day, F.col(user).alias("user")).where(F.col("user").isNotNull()), "user")
    daily = bitmaps.table(e, [*keys, "day"], "number")
    ends = daily.select(*keys, F.col("day").alias("__end")).distinct()
    until = F.explode(F.sequence(F.lit(0), F.lit(window_days - 1))).alias("__ahead")
    reach = daily.select("*", until).withColumn("__end", F.date_add("day", F.col("__ahead")))
    unions = bitmaps.counted(reach.join(ends, [*keys, "__end"], "left_semi"), [*keys, "__end"], "active_users")
    return unions.withColumnRenamed("__end", "day")


def first_last_version(df: DataFrame, metric: str, version: str, install: str) -> DataFrame:
    """First and last version a metric was seen in, as sortable integer major * 100 + minor, with approximate installs."""
    parts = F.split(version, "\\.")
    code = F.get(parts, F.lit(0)).try_cast("int") * 100 + F.get(parts, F.lit(1)).try_cast("int")
    return df.groupBy(metric).agg(
        F.min(code).alias("first_version"), F.max(code).alias("last_version"),
        F.approx_count_distinct(install).alias("installs_estimate"))


def usage_estimate(df: DataFrame, keys: Sequence[str], reporting: str, seats: str, recorded: str) -> DataFrame:
    """Totals scaled up by the share of the base that reports, by count and by seats."""
    g = df.groupBy(*keys).agg(
        F.count_if(F.col(reporting)).alias("reporting_count"), F.count_if(~F.col(reporting)).alias("not_reporting_count"),
        F.sum(F.when(F.col(reporting), F.col(seats)).otherwise(0)).alias("reporting_seats"),
        F.sum(F.when(~F.col(reporting), F.col(seats)).otherwise(0)).alias("not_reporting_seats"),
        F.sum(F.when(F.col(reporting), F.col(recorded)).otherwise(0)).alias("recorded"))
    by_count = ratio("reporting_count", F.col("reporting_count") + F.col("not_reporting_count"))
    by_seats = ratio("reporting_seats", F.col("reporting_seats") + F.col("not_reporting_seats"))
    return g.select("*", by_count.alias("count_coverage"), by_seats.alias("seat_coverage"),
                    ratio("recorded", by_count).alias("estimate_by_count"), ratio("recorded", by_seats).alias("estimate_by_seats"))


def monthly_delta(df: DataFrame, keys: Sequence[str], month: str, counter: str) -> DataFrame:
    """Change of a cumulative counter per period; a reset counts as 0. Input at (keys, period) grain."""
    w = W.partitionBy(*keys).orderBy(month)
    step = F.col(counter) - F.coalesce(F.lag(counter).over(w), F.lit(0))
    return df.withColumn(f"{counter}_delta", F.greatest(step, F.lit(0)))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: ordered.Block, measures: Sequence[str]) -> DataFrame:
    return ordered.with_running_sum(df, keys, order, block, {f"{m}_to_date": m for m in measures})


def funnel_base(events: DataFrame, user: str, kind: str, ts: str, steps: Sequence[str]) -> DataFrame:
    """How far each user got through ordered steps, with the first time of every step."""
    pos = {s: n for n, s in enumerate(steps, 1)}
    step = F.coalesce(*[F.when(F.col(kind) == s, n) for s, n in pos.items()])
    g = events.where(F.col(kind).isin(*steps)).groupBy(user).agg(
        F.max(step).alias("max_step"), *[F.min(F.when(F.col(kind) == s, F.col(ts))).alias(f"{s}_at") for s in steps])
    reached = F.lit(0)
    prev, ok = None, F.lit(True)
    for s in steps:
        at = F.col(f"{s}_at")
        ok = ok & at.isNotNull() & (F.lit(True) if prev is None else at >= prev)
        reached = F.when(ok, pos[s]).otherwise(reached)
        prev = at
    return g.withColumn("steps_in_order", reached)


def outcome_with_precedence(df: DataFrame, key: str, kind: str, precedence: Sequence[str]) -> DataFrame:
    """One outcome per key: the first of ``precedence`` that occurred beats the later ones."""
    rank = F.coalesce(*[F.when(F.col(kind) == o, n) for n, o in enumerate(precedence)])
    g = df.where(F.col(kind).isin(*precedence)).groupBy(key).agg(F.min(rank).alias("__r"))
    return g.select(key, F.element_at(F.array(*[F.lit(o) for o in precedence]), F.col("__r") + 1).alias("outcome"))


def activation(events: DataFrame, entity: str, kind: str, ts: str, created: str, milestones: Sequence[str],
               fast_minutes: int, slow_minutes: int) -> DataFrame:
    """Minutes from creation to each milestone and a speed class of the last one."""
    g = events.groupBy(entity).agg(
        F.min(F.when(F.col(kind) == created, F.col(ts))).alias("created_at"),
        *[F.min(F.when(F.col(kind) == m, F.col(ts))).alias(f"{m}_at") for m in milestones])
    out = g.select("*", *[boundary_diff("minute", "created_at", f"{m}_at").alias(f"minutes_to_{m}") for m in milestones])
    last = F.col(f"minutes_to_{milestones[-1]}")
    return out.withColumn("activation_class", F.when(last.isNull(), "never").when(last < 0, "before creation")
                          .when(last <= fast_minutes, "fast").when(last <= slow_minutes, "normal").otherwise("slow"))


def first_last_attributes(df: DataFrame, key: str, order: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """First non-null and last non-null value of attributes per key, as aggregates instead of full-frame windows."""
    rank = F.struct(*order)
    aggs = []
    for a in attrs:
        at = F.when(F.col(a).isNotNull(), rank)
        aggs += [F.min_by(a, at).alias(f"first_{a}"), F.max_by(a, at).alias(f"last_{a}")]
    return df.groupBy(key).agg(*aggs)


def colour(score: Column) -> Column:
    return F.when(score == 25, "Red").when(score == 63, "Yellow").when(score == 88, "Green")


def points(x: Column, low: float, high: float | None, at_least: bool = False) -> Column:
    """25 / 63 / 88 points; without a second threshold the middle class is missing. A value on a threshold belongs to the class
    below it, or with ``at_least`` to the one above."""
    if at_least:
        return F.when(x < low, 25).when(x < (low if high is None else high), 63).when(x >= low, 88)
    if high is None:
        return F.when(x <= low, 25).when(x > low, 88)
    return F.when(x <= low, 25).when(x <= high, 63).when(x > high, 88)


def health_score(df: DataFrame, age: str, metric: str, by_age: Sequence[tuple[int, int | None, float, float | None]],
                 plain: Mapping[str, tuple], weights: Mapping[str, float]) -> DataFrame:
    """Points and colours per metric and their weighted mean over the metrics that have a score.

    ``by_age`` gives (age from, age below, low, high) rows for ``metric``; ``plain`` fixed thresholds for the others, with a
    third entry True where a value on a threshold belongs to the class above.
    """
    score = F.lit(None).cast("int")
    for a, b, lo, hi in by_age:
        inside = (F.col(age) >= a) & (F.lit(True) if b is None else F.col(age) < b)
        score = F.when(inside, points(F.col(metric), lo, hi)).otherwise(score)
    scores = {metric: score, **{m: points(F.col(m), *limits) for m, limits in plain.items()}}
    out = df.select("*", *[v.alias(f"{m}_score") for m, v in scores.items()])
    weight = sum((F.when(F.col(f"{m}_score").isNotNull(), w).otherwise(0.0) for m, w in weights.items()), F.lit(0.0))
    total = sum((F.coalesce(F.col(f"{m}_score") * w, F.lit(0.0)) for m, w in weights.items()), F.lit(0.0))
    return out.select("*", *[colour(F.col(f"{m}_score")).alias(f"{m}_color") for m in scores], ratio(total, weight).alias("overall_score"))


def license_utilization(use: DataFrame, subscription: str, day: str, instance: str, users: str, licensed: str, kind: str,
                        trials: Sequence[tuple[DataFrame, str]], products: Mapping[str, str], production: str = "Production") -> DataFrame:
    """Flags ``is_<name>_trial`` per trial product and ``is_max_instance``, for every row of use.

    A row with licensed users is in a trial of a product when any of ``trials`` covers its day: pairs of a table ``(key, product, start, end)``, both
    ends included, and its key in ``use`` (installation, namespace). Of a subscription's instances of a day the one with most ``users`` (NULL last) is the
    largest, and it is flagged only if its ``kind`` is ``production``. Trials are met in cells of days, not day by day.
    """
    out = use
    date = lambda x: F.unix_date(F.col(x).cast("date"))
    for n, (table, key) in enumerate(trials):
        days = use.where(F.col(key).isNotNull() & (F.col(licensed) > 0)).select(F.col(key).alias("__key"), F.col(day).alias("__day")).distinct()
        spans = table.select(F.col(key).alias("__key"), "product", F.col("start").alias("__from"), F.col("end").alias("__to"))
        hit = points_in(days, spans, ["__key"], date("__day"), date("__from"), date("__to"))
        hit = hit.groupBy("__key", "__day").agg(*[F.max(F.col("product") == p).alias(f"__{n}_{x}") for x, p in products.items()])
        out = out.join(hit, (F.col(key) == F.col("__key")) & (F.col(day) == F.col("__day")), "left").drop("__key", "__day")
    top = use.groupBy(subscription, day).agg(F.max_by(instance, F.struct(users, instance)).alias("__top"))
    some = lambda x: reduce(lambda a, b: a | b, [F.coalesce(f"__{n}_{x}", F.lit(False)) for n in range(len(trials))], F.lit(False)) & (F.col(licensed) > 0)
    return out.join(top, [subscription, day]).select(
        *use.columns, *[F.coalesce(some(x), F.lit(False)).alias(f"is_{x}_trial") for x in products],
        F.coalesce((F.col("__top") == F.col(instance)) & (F.col(kind) == production), F.lit(False)).alias("is_max_instance"))


def storage_allowance(df: DataFrame, owner: Sequence[str], size: str, free_limit: str, purchased_limit: str) -> DataFrame:
    """Free and paid part of every item's storage, and whether the item is capped by what its owner bought."""
    up = ~((F.col(size) < F.col(free_limit)) | (F.col(free_limit) == 0))
    free = F.when(~up | (F.col(purchased_limit) == 0), F.col(size)).otherwise(F.col(free_limit))
    out = df.select("*", up.alias("is_free_storage_used_up"), free.alias("free_storage"), (F.col(size) - free).alias("paid_storage"))
    out = ordered.with_totals(out, owner, {"total_paid_storage": F.sum("paid_storage")})
    capped = F.col("is_free_storage_used_up") & ((F.col(purchased_limit) == 0) | (F.col("total_paid_storage") >= F.col(purchased_limit)))
    return out.withColumn("is_capped", capped)


def quota_usage(df: DataFrame, used: str, allowance: str, purchased: str, enabled: str) -> DataFrame:
    """Use split into the monthly allowance and purchased units, with limit and status labels."""
    extra = F.when((F.col(purchased) == 0) | (F.col(used) < F.col(allowance)), F.lit(0.0)).otherwise(F.col(used) - F.col(allowance))
    limited = F.col(enabled) & (F.col(allowance) != 0)
    out = df.select("*", extra.alias("purchased_used"), (F.col(used) - extra).alias("monthly_used"), limited.alias("limit_enabled"))
    m = F.col("monthly_used")
    return out.select(
        "*",
        F.when(F.col("limit_enabled"), F.col(allowance).cast("string")).when(F.col(allowance) == 0, "Unlimited").otherwise("Not supported").alias("limit_label"),
        F.when(~F.col("limit_enabled"), "Disabled").when(m < F.col(allowance), "Under Quota").otherwise("Over Quota").alias("status"),
        F.when((F.col("purchased_used") <= F.col(purchased)) | ~F.col("limit_enabled"), "Under Quota").otherwise("Over Quota").alias("status_purchased"))


def peak_rate(events: DataFrame, ts: str, unit: str = "second", by: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """Highest count per small unit within a larger one."""
    small = events.groupBy(*keys, F.date_trunc(unit, F.col(ts)).alias("__t")).agg(F.count("*").alias("__n"))
    return small.groupBy(*keys, F.date_trunc(by, F.col("__t")).cast("date").alias(by)).agg(F.max("__n").alias("peak"), F.sum("__n").alias("total"))


def feature_matrix(df: DataFrame, keys: Sequence[str], stage: str, frame: str, item: str, stages: Sequence[str],
                   frames: Sequence[str]) -> DataFrame:
    """Distinct items per stage and frame as columns, with each stage's share within the frame."""
    values = [f"{s}_{f}" for s in stages for f in frames]
    g = df.groupBy(*keys).pivot("__cell", values) if "__cell" in df.columns else \
        df.withColumn("__cell", F.concat_ws("_", stage, frame)).groupBy(*keys).pivot("__cell", values)
    wide = g.agg(F.countDistinct(item)).na.fill(0, values)
    shares = []
    for f in frames:
        total = sum((F.col(f"{s}_{f}") for s in stages), F.lit(0))
        shares += [div0(F.col(f"{s}_{f}"), total).alias(f"{s}_{f}_share") for s in stages]
    return wide.select("*", *shares)


def weighted_usage_share(df: DataFrame, day: str, keys: Sequence[str], usage: str, weight: Column, cost: str) -> DataFrame:
    """Usage times a cost factor per key and day, its share of the day and the cost per weighted unit."""
    g = df.groupBy(day, *keys).agg(F.sum(F.col(usage) * weight).alias("weighted"), F.sum(cost).alias("cost"))
    g = ordered.with_totals(g, [day], {"__day": F.sum("weighted")})
    return g.select(day, *keys, "weighted", "cost", ratio("weighted", "__day").alias("share"), ratio("cost", "weighted").alias("cost_per_unit"))


def campaign_metrics(df: DataFrame, campaign: str, ts: str, kind: str, user: str, kinds: Sequence[str]) -> DataFrame:
    """Totals and distinct users of each kind per campaign and day.

    Folded to (campaign, day, kind, user) first, so the distinct counts need no expansion of the raw rows.
    """
    folded = df.where(F.col(kind).isin(*kinds)).groupBy(campaign, F.to_date(F.col(ts)).alias("day"), kind, user).agg(F.count("*").alias("n"))
    aggs = []
    for k in kinds:
        hit = F.col(kind) == k
        aggs += [F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"total_{k}"), F.count_if(hit).alias(f"unique_{k}")]
    return folded.groupBy(campaign, "day").agg(*aggs)


def collaboration_count(items: DataFrame, item: str, month: str, group: str) -> DataFrame:
    """Distinct groups per item, and mean and exact median of that per month."""
    per = items.groupBy(item, month).agg(F.countDistinct(group).alias("groups"))
    mid = ordered.quantiles(per, [month], "groups", {"median_groups": 0.5})
    return per.groupBy(month).agg(F.avg("groups").alias("mean_groups"), F.count("*").alias("items")).join(mid, month)
