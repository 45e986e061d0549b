"""Targets, stages, attribution, scaffolds and entity matching."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import div0, div0null, ratio
from tidemark.operators import history, ordered
from tidemark.operators.calendar import expand_interval, fiscal_attributes, nth_business_day
from tidemark.operators.keys import latest_per_key


def allocate_target_daily(targets: DataFrame, month: str, target: str) -> DataFrame:
    """Monthly target spread evenly over the month's days."""
    first, last = F.trunc(F.col(month), "month"), F.last_day(F.col(month))
    days = F.datediff(last, first) + 1
    return targets.select(*[x for x in targets.columns if x != target], (F.col(target) / days).alias("daily_target"),
                          F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("day"))


def to_date_totals(df: DataFrame, keys: Sequence[str], day: str, measure: str) -> DataFrame:
    """Week-, month-, quarter- and year-to-date totals of daily rows; rows per key are bounded by the calendar."""
    out = df
    for name, unit in (("wtd", "week"), ("mtd", "month"), ("qtd", "quarter"), ("ytd", "year")):
        w = W.partitionBy(*keys, F.trunc(day, unit)).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumn(f"{measure}_{name}", F.sum(measure).over(w))
    return out


def stage_progression(hist: DataFrame, item: str, stage: str, at: str, created: str, open_stages: Sequence[str], lost: str,
                      won: str, as_of: dt.date) -> DataFrame:
    """Stage dates side by side, missing ones back-filled from the next known stage, and days spent per stage.

    Open items are filled from later open stages only; closed ones also from the close date. Negative days count 0.
    """
    wide = hist.groupBy(item).pivot(stage, [*open_stages, lost, won]).agg(F.max(at))
    wide = wide.join(hist.groupBy(item).agg(F.min(created).alias("created_date")), item)
    category = F.when(F.col(lost).isNotNull(), "Lost").when(F.col(won).isNotNull(), "Won").otherwise("Open")
    out = wide.select(item, "created_date", category.alias("stage_category"), F.coalesce(lost, won).alias("close_date"),
                      *[F.col(s) for s in open_stages])
    is_open = F.col("stage_category") == "Open"
    dates = [F.coalesce(open_stages[0], "created_date")]
    for k in range(1, len(open_stages)):
        later = [F.col(s) for s in open_stages[k:]]
        dates.append(F.when(is_open, F.coalesce(*later)).otherwise(F.coalesce(*later, F.col("close_date"))))
    out = out.select(item, "stage_category", "created_date", "close_date", *[d.alias(f"{s}_date") for s, d in zip(open_stages, dates)])
    days = []
    for k, s in enumerate(open_stages):
        end = F.col(f"{open_stages[k + 1]}_date") if k + 1 < len(open_stages) else F.col("close_date")
        gap = F.datediff(end, f"{s}_date")
        days.append(F.when(gap < 0, 0).otherwise(gap).alias(f"{s}_days"))
    last_known = F.coalesce(*[F.col(f"{s}_date") for s in reversed(open_stages)], F.col("created_date"))
    return out.select("*", *days, F.when(is_open, F.datediff(F.lit(as_of), last_known)).alias("current_days"))


def stage_regression(hist: DataFrame, item: str, stage_number: str, order: Sequence[str], block: ordered.Block = None) -> DataFrame:
    """Whether an item ever moved back to an earlier stage."""
    prev = ordered.with_previous(hist, [item], order, block, {"__p": stage_number})
    back = F.coalesce(F.col("__p") > F.col(stage_number), F.lit(False))
    return prev.groupBy(item).agg(F.max(back.cast("int")).alias("is_stage_regression"))


def journey(milestones: DataFrame, item: str, stage: str, order: Sequence[str], block: ordered.Block = None) -> DataFrame:
    """Ordered stage history: position, entry, exit, next stage and days in the stage."""
    at = order[0]
    block = ordered.cut(milestones, [item], order) if block is None else block
    numbered = ordered.with_row_index(milestones, [item], order, block, "stage_order")
    nxt = ordered.with_next(numbered, [item], order, block, {"next_stage": stage, "exit_at": at})
    return nxt.select(item, "stage_order", stage, F.col(at).alias("entry_at"), "exit_at", "next_stage", F.datediff("exit_at", at).alias("days_in_stage"))


def stage_funnel(hist: DataFrame, item: str, stage: str, at: str, stages: Sequence[str]) -> DataFrame:
    """``hit`` flags, days to the next stage and the stage an item dropped out at."""
    g = hist.groupBy(item).agg(*[F.min(F.when(F.col(stage) == s, F.col(at))).alias(f"{s}_at") for s in stages])
    hits = [F.col(f"{s}_at").isNotNull().alias(f"hit_{s}") for s in stages]
    turns = [F.datediff(f"{b}_at", f"{a}_at").alias(f"turn_{a}_to_{b}") for a, b in zip(stages, stages[1:])]
    last = F.when(F.lit(False), F.lit(""))
    for s in reversed(stages):
        last = last.when(F.col(f"{s}_at").isNotNull(), s)
    return g.select(item, *hits, *turns, last.alias("furthest_stage"))


def attribution(touches: DataFrame, conversions: DataFrame, key: str, at: str, touch_id: str, conversion_id: str, channel: str,
                weight: Column, decay_days: int = 180, window_days: int = 365) -> DataFrame:
    """Credit of each touch before a conversion; the credits of a conversion sum to 1.

    A touch belongs to the key's next conversion when that follows within ``window_days``. Time decay is 0.33 of a
    first-touch and 0.67 of a last-touch weight, each falling to 0 over ``decay_days`` and normalised; the blend is
    0.4 time decay and 0.6 channel weight, renormalised. The sums of a conversion come from its touches folded to one
    row per day and channel (at most ``window_days`` days), so a conversion with very many touches is never gathered.
    """
    linked = history.next_match(touches.select(key, at, touch_id, channel), conversions.select(key, at, conversion_id), [key], at, [conversion_id])
    conv, conv_at = f"matched_{conversion_id}", f"matched_{at}"
    t = linked.where(F.datediff(conv_at, at).between(0, window_days)).select(
        F.col(conv).alias("conversion"), touch_id, channel, F.to_date(F.col(at)).alias("__day"), weight.alias("__w"))
    fade = lambda days: 1 - F.least(F.lit(1.0), days / decay_days)
    w = W.partitionBy("conversion")
    days = t.groupBy("conversion", "__day", channel).agg(F.count("*").alias("__n"), F.sum("__w").alias("__w"))
    days = days.select("*", F.min("__day").over(w).alias("__first"), F.max("__day").over(w).alias("__last"))
    sums = days.groupBy("conversion", "__first", "__last").agg(
        F.sum(F.col("__n") * fade(F.datediff("__day", "__first"))).alias("__sum_f"), F.sum(F.col("__n") * fade(F.datediff("__last", "__day"))).alias("__sum_l"),
        F.sum("__w").alias("__sum_w"), F.countDistinct(channel).alias("channels"))
    t = t.join(sums, "conversion")
    decay = 0.67 * div0null(fade(F.datediff("__last", "__day")), "__sum_l") + 0.33 * div0null(fade(F.datediff("__day", "__first")), "__sum_f")
    t = t.select("conversion", touch_id, channel, "channels", decay.alias("time_decay_weight"), div0("__w", "__sum_w").alias("data_weight"), "__sum_w")
    # the first and the last touch weigh 1, so both decays are normalised; the channel weights are unless all are 0
    total = F.when(F.col("__sum_w") == 0, 0.4).otherwise(1.0)
    return t.withColumn("weight", (0.4 * F.col("time_decay_weight") + 0.6 * F.col("data_weight")) / total).drop("__sum_w")


def scaffold(dim_sets: Sequence[DataFrame], periods: Column) -> DataFrame:
    """Every dimension combination seen in any of the sets, on every period of an array column.

    The combinations are the distinct union of the sets; the periods are generated per row, so there is no cross join.
    """
    out = dim_sets[0]
    for d in dim_sets[1:]:
        out = out.unionByName(d)
    return out.distinct().select("*", F.explode(periods).alias("period"))


def quarter_coverage(snapshots: DataFrame, targets: DataFrame, keys: Sequence[str], snapshot_date: str, close_date: str,
                     open_amount: str, booked_amount: str) -> DataFrame:
    """Open and booked amounts per snapshot day, re-based to the end of the closing quarter, beside the target.

    ``targets`` carries keys, close_quarter and target. Day 0 is 90 days before the quarter's end.
    """
    fiscal = fiscal_attributes(F.col(close_date))
    rebased = F.datediff(snapshot_date, fiscal["last_day_of_fiscal_quarter"]) + 90
    daily = snapshots.select(*keys, fiscal["fiscal_quarter_name_fy"].alias("close_quarter"), F.col(snapshot_date).alias("snapshot_date"),
                             rebased.alias("snapshot_day"), F.col(open_amount).alias("__o"), F.col(booked_amount).alias("__b"))
    daily = daily.where(F.col("snapshot_day").between(-92, 90)).groupBy(*keys, "close_quarter", "snapshot_date", "snapshot_day").agg(
        F.sum("__o").alias("open_amount"), F.sum("__b").alias("booked_amount"))
    dims = daily.select(*keys, "close_quarter").unionByName(targets.select(*keys, "close_quarter")).distinct()
    days = daily.select("close_quarter", "snapshot_date", "snapshot_day").distinct()
    grid = dims.join(days, "close_quarter")
    out = grid.join(daily, [*keys, "close_quarter", "snapshot_date", "snapshot_day"], "left").join(targets, [*keys, "close_quarter"], "left")
    need = F.col("target") - F.coalesce("booked_amount", F.lit(0.0))
    return out.select(*keys, "close_quarter", "snapshot_date", "snapshot_day", F.coalesce("open_amount", F.lit(0.0)).alias("open_amount"),
                      F.coalesce("booked_amount", F.lit(0.0)).alias("booked_amount"), "target", ratio(F.coalesce("open_amount", F.lit(0.0)), need).alias("coverage"))


def ramp_status(people: DataFrame, start: str, end: str, horizon: dt.date, ramp_days: int) -> DataFrame:
    """Ramping or ramped on every day of service."""
    days = expand_interval(people, start, end, "day", horizon, "day")
    age = F.datediff("day", start)
    return days.withColumn("ramp_status", F.when(age < ramp_days, "ramping").otherwise("ramped"))


def ramp_intervals(people: DataFrame, start: str, end: str, ramp_days: int) -> DataFrame:
    """The part of a service spent ramping and the part after it, as intervals ``[ramp_from, ramp_to)``; an open end stays open."""
    turn = F.date_add(start, ramp_days)
    piece = lambda label, a, b: F.struct(F.lit(label).alias("ramp_status"), a.alias("ramp_from"), b.alias("ramp_to"))
    parts = F.array(piece("ramping", F.col(start), F.least(F.coalesce(F.col(end), turn), turn)), piece("ramped", turn, F.col(end)))
    return people.select("*", F.explode(parts).alias("__p")).select(*people.columns, "__p.*")


def forecast_buckets(booked: DataFrame, snapshots: DataFrame, account: str, quarter: str) -> DataFrame:
    """Bookings by whether the account had open business at the quarter's start. ``snapshots`` holds (account, quarter)."""
    had = snapshots.select(account, quarter).distinct().withColumn("__had", F.lit(True))
    out = booked.join(had, [account, quarter], "left")
    return out.withColumn("bucket", F.when(F.col("__had"), "from open business").otherwise("new in quarter")).drop("__had")


def booking_buckets(booked: DataFrame, snapshots: DataFrame, account: str, quarter: str, closed: str, name: str, order_type: str, category: str, won: Column,
                    business_day: int = 3) -> DataFrame:
    """Bookings of a quarter (its first day) by where they came from, the first that fits.

    ``Bad Debt`` (won, by its name), ``Churn/Contraction`` (order types 4 to 6), ``Accounting`` (decommissioned or internal), ``Already Booked`` (closed by the
    third business day of its quarter); then by what the account had open on that day in ``snapshots`` (account, quarter, ``snapshot_date``,
    ``close_quarter``): ``Starting`` with a deal to close in the quarter, ``Pulled Forward`` with one to close later; else ``Created and Closed``.
    """
    open_then = snapshots.where(F.col("snapshot_date") == nth_business_day(F.col(quarter), business_day)).groupBy(account, quarter).agg(
        F.max(F.col("close_quarter") == F.col(quarter)).alias("__starting"), F.max(F.col("close_quarter") > F.col(quarter)).alias("__later"))
    low = F.lower(F.col(name))
    bad_debt = won & (low.like("%bad debt%") | low.like("% bd %") | low.like("% bdd %"))
    some = lambda x, patterns: reduce(lambda a, b: a | b, [F.col(x).like(p) for p in patterns])
    no = F.lit(False)
    bucket = (
        F.when(F.coalesce(bad_debt, no), "Bad Debt").when(F.coalesce(some(order_type, ("%4%", "%5%", "%6%")), no), "Churn/Contraction")
        .when(F.coalesce(some(category, ("%Decom%", "%Internal%")), no), "Accounting")
        .when(F.coalesce((F.trunc(closed, "quarter") == F.col(quarter)) & (F.col(closed) <= nth_business_day(F.col(quarter), business_day)), no), "Already Booked")
        .when(F.coalesce("__starting", no), "Starting").when(F.coalesce("__later", no), "Pulled Forward").otherwise("Created and Closed"))
    return booked.join(open_then, [account, quarter], "left").withColumn("bucket", bucket).drop("__starting", "__later")


# Company suffixes a name is cleaned of.
COMPANY_SUFFIXES = ("llc", "inc", "ltd", "corporation", "corp", "co", "limited", "gmbh", "university", "bv")


def clean_company_name(x: Column) -> Column:
    bare = F.regexp_replace(F.lower(x), r"\b(" + "|".join(COMPANY_SUFFIXES) + r")\b\.?", "")
    return F.trim(F.regexp_replace(bare, r"[^a-z0-9\s]", ""))


def match_entities(left: DataFrame, right: DataFrame, left_id: str, left_name: str, left_domain: str, right_id: str, right_name: str,
                   right_domain: str, most_common: int = 25, trusted: Sequence[str] = (), without: Sequence[str] = (), without_raw: Sequence[str] = (),
                   min_length: int = 4) -> DataFrame:
    """Match two lists by mail domain and by cleaned company name; one best match per left row.

    The ``most_common`` names of the left list are taken for bad guesses, unless ``trusted``: their rows match neither by name nor by domain. Names
    shorter than ``min_length`` don't match by name. Right rows are left out whose cleaned name is like one of ``without`` (LIKE patterns) or
    whose own name, lower-cased, is like one of ``without_raw``. The domain beats the name and the smallest right id wins, so the right
    list is folded to one id per domain and per name before the join: a common domain costs its rows, never all pairs.
    """
    clean = left.select(left_id, F.lower(left_domain).alias("__d"), clean_company_name(F.col(left_name)).alias("__n"))
    common = clean.where(F.col("__n").isNotNull()).groupBy("__n").agg(F.count("*").alias("__c")).orderBy(F.col("__c").desc(), "__n").limit(most_common)
    if trusted:
        common = common.where(~F.col("__n").isin(*trusted))
    bad = common.select(F.col("__n").alias("__bad"))
    keyed = clean.join(bad, F.col("__n") == F.col("__bad"), "left").select(
        left_id, F.when(F.col("__bad").isNull(), F.col("__d")).alias("__d"),
        F.when(F.col("__bad").isNull() & (F.length("__n") >= min_length), F.col("__n")).alias("__k"))
    r = right.select(F.col(right_id).alias("id"), F.lower(right_domain).alias("__d"), clean_company_name(F.col(right_name)).alias("__k"), F.lower(right_name).alias("__raw"))
    for column, patterns in (("__k", without), ("__raw", without_raw)):
        for x in patterns:
            r = r.where(F.col(column).isNull() | ~F.col(column).like(x))
    by_domain = r.where(F.col("__d").isNotNull()).groupBy("__d").agg(F.min("id").alias("__by_domain"))
    by_name = r.groupBy("__k").agg(F.min("id").alias("__by_name"))
    out = keyed.join(by_domain, "__d", "left").join(by_name, "__k", "left")
    rule = F.when(F.col("__by_domain").isNotNull(), "domain").when(F.col("__by_name").isNotNull(), "name")
    return out.select(left_id, F.coalesce("__by_domain", "__by_name").alias("match_id"), rule.alias("rule")).where(F.col("rule").isNotNull())


def company_score(df: DataFrame, group: str, company: str, user: str, role: str) -> DataFrame:
    """How strongly each company stands behind a group: weighted share of its creators, owners and users, majority and
    spread over roles; the best company is ranked first. Distinct counts are aggregates joined back, not windows."""
    def count(kind):
        return F.countDistinct(F.when(F.col(role) == kind, F.col(user)))

    kinds = ("creator", "owner", "user")
    total = df.groupBy(group).agg(F.countDistinct(user).alias("everyone"), *[count(k).alias(f"all_{k}s") for k in kinds])
    per = df.groupBy(group, company).agg(*[count(k).alias(f"n_{k}") for k in kinds])
    j = per.join(total, group)
    part = {k: F.coalesce(ratio(f"n_{k}", f"all_{k}s"), F.lit(0.0)) for k in kinds}
    user_score = part["creator"] * 0.6 + part["owner"] * 0.3 + part["user"] * 0.1
    pair = lambda a, b: ((F.col(f"n_{a}") > 0) & (F.col(f"n_{b}") > 0)).cast("int")
    spread = (pair("creator", "user") + pair("creator", "owner") + pair("owner", "user")) / 3
    most = F.when((F.col("n_creator") + F.col("n_owner") + F.col("n_user")) / F.col("everyone") > 0.5, 1).otherwise(0)
    j = j.select(group, company, *[f"n_{k}" for k in kinds], user_score.alias("user_score"), most.alias("company_score"),
                 ((user_score + most + spread) / 3 * 100).alias("combined_score"))
    best = j.groupBy(group).agg(F.max_by(company, F.struct("combined_score", company)).alias("best_company"))
    return j.join(best, group).withColumn("is_best", F.col("best_company") == F.col(company)).drop("best_company")


def aggregate_then_enrich(facts: DataFrame, key: str, measures: Mapping[str, Column], dim: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Facts folded to the key before the join; attributes folded by MAX so the join cannot fan out."""
    folded = facts.groupBy(key).agg(*[m.alias(n) for n, m in measures.items()])
    one = dim.groupBy(key).agg(*[F.max(a).alias(a) for a in attrs])
    return folded.join(one, key, "left")


def unify_activities(tables: Mapping[str, DataFrame], person: str, at: str, activity: str, flagged: Sequence[str]) -> DataFrame:
    """Typed activity tables as one: shared columns, each table's own columns NULL elsewhere, and a flag for activities
    a person did themselves. A union by name replaces a spine with a dozen left joins."""
    out = None
    for kind, d in tables.items():
        one = d.withColumn("activity_type", F.lit(kind)).withColumn("is_person_activity", F.lit(kind in flagged))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def lead_to_revenue(persons: DataFrame, conversions: DataFrame, key: str) -> DataFrame:
    """Persons and conversions on one line with coalesced ids; either may lack the other."""
    p = persons.select(F.col(key).alias("__pk"), *[x for x in persons.columns if x != key])
    c = conversions.select(F.col(key).alias("__ck"), *[x for x in conversions.columns if x != key])
    j = p.join(c, F.col("__pk") == F.col("__ck"), "full")
    kind = F.when(F.col("__pk").isNull(), "conversion only").when(F.col("__ck").isNull(), "person only").otherwise("converted")
    return j.select(F.coalesce("__pk", "__ck").alias(key), *[x for x in j.columns if not x.startswith("__")], kind.alias("record_type"))
