"""Recurring revenue: movement, its decomposition, retention, cohorts, renewals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import ratio
from tidemark.operators import ordered
from tidemark.operators.calendar import densify, fiscal_attributes
from tidemark.operators.keys import latest_per_key

# Names of a change of recurring amount.
NEW, EXPANSION, CONTRACTION, CHURN, SAME = "New", "Expansion", "Contraction", "Churn", "No Impact"


def change_type(now: Column, before: Column, position: Column) -> Column:
    """Label of the step from one period's amount to the next; ``position`` is the period's rank for the key."""
    return (
        F.when((now > 0) & (position == 1), NEW)
        .when((now == 0) & (before > 0), CHURN)
        .when((now < before) & (now > 0), CONTRACTION)
        .when((now > before) & (position > 1), EXPANSION)
        .when(now == before, SAME)
    )


def movement(df: DataFrame, key: str, month: str, amount: str, others: Sequence[str] = ()) -> DataFrame:
    """Monthly movement per key with one month after the last, so that a loss shows as churn.

    Input at (key, month) grain; rows per key are bounded by the calendar.
    """
    dense = densify(df, [key], month, 1, [amount, *others])
    w = W.partitionBy(key).orderBy(month)
    prev = {f"previous_{m}": F.coalesce(F.lag(m).over(w), F.lit(0)) for m in [amount, *others]}
    out = dense.select(key, month, amount, *others, *[v.alias(k) for k, v in prev.items()],
                       F.row_number().over(w).alias("position"))
    kind = change_type(F.col(amount), F.col(f"previous_{amount}"), F.col("position"))
    return out.select("*", kind.alias("change_type"), (F.col(amount) - F.col(f"previous_{amount}")).alias("delta"))


def decompose_delta(df: DataFrame, kind: str = "change_type") -> DataFrame:
    """Parts of an amount change that come from seats, price and tier.

    Wants ``amount, previous_amount, quantity, previous_quantity, tier, previous_tier``. The down-tier part uses the
    prior amount per prior seat, as the other parts do.
    """
    q0, q1 = F.col("previous_quantity"), F.col("quantity")
    a0, a1 = F.col("previous_amount"), F.col("amount")
    t0, t1 = F.col("previous_tier"), F.col("tier")
    per_seat_step = ratio(a1, q1) - ratio(a0, q0)
    seat = (
        F.when(F.col(kind).isin(EXPANSION, CONTRACTION) & (q0 != q1) & (q0 > 0), F.coalesce(ratio(a0, q0) * (q1 - q0), F.lit(0.0)))
        .when((q0 != q1) & (q0 == 0), a1).otherwise(F.lit(0.0))
    )
    zero = F.lit(0.0)
    return df.select(
        "*",
        seat.alias("seat_change"),
        F.when(t0 == t1, q1 * per_seat_step).otherwise(zero).alias("price_change"),
        F.when(t0 != t1, F.coalesce(q1 * per_seat_step, zero)).otherwise(zero).alias("tier_change"),
        F.when(t0 < t1, F.coalesce(q1 * per_seat_step, zero)).otherwise(zero).alias("uptier_change"),
        F.when(t0 > t1, F.coalesce(q1 * per_seat_step, zero)).otherwise(zero).alias("downtier_change"),
        per_seat_step.alias("price_per_seat_change"),
    )


def shifted_pair(df: DataFrame, keys: Sequence[str], month: str, measures: Sequence[str], lag_months: int, how: str) -> DataFrame:
    """Every row beside the same key's row ``lag_months`` later; ``how`` is left (all earlier rows) or full.

    Each row stands for itself and for its shifted month, and the two meet in one aggregation by (keys, month): one
    shuffle instead of a self join. Input unique at (keys, month).
    """
    none = {m: F.lit(None).cast(df.schema[m].dataType) for m in measures}
    now = F.struct(F.col(month).alias("later_month"), F.lit(False).alias("__then"), *[none[m].alias(f"then_{m}") for m in measures],
                   *[F.col(m).alias(f"later_{m}") for m in measures])
    then = F.struct(F.add_months(month, lag_months).alias("later_month"), F.lit(True).alias("__then"),
                    *[F.col(m).alias(f"then_{m}") for m in measures], *[none[m].alias(f"later_{m}") for m in measures])
    rows = df.select(*keys, F.explode(F.array(now, then)).alias("r")).select(*keys, "r.*")
    values = [f"{side}_{m}" for side in ("then", "later") for m in measures]
    out = rows.groupBy(*keys, "later_month").agg(F.max("__then").alias("__then"), *[F.max(v).alias(v) for v in values])
    if how == "left":
        out = out.where("__then")
    return out.drop("__then")


def retention(df: DataFrame, keys: Sequence[str], month: str, amount: str, lag_months: int = 12) -> DataFrame:
    """Net and gross retained amount ``lag_months`` later."""
    pair = shifted_pair(df, keys, month, [amount], lag_months, "left")
    then, net = F.col(f"then_{amount}"), F.coalesce(f"later_{amount}", F.lit(0.0))
    return pair.select(
        *keys, F.col("later_month").alias("retention_month"), then.alias("prior_amount"), net.alias("net_retention"),
        F.when(net > 0, F.least(net, then)).otherwise(F.lit(0.0)).alias("gross_retention"),
        change_type(net, then, F.lit(2)).alias("retention_type"),
    )


def amount_band(x: Column) -> Column:
    return (F.when(x > 100000, "1. > 100K").when(x > 5000, "2. 5K-100K").when(x <= 5000, "3. <= 5K"))


def movement_between(df: DataFrame, keys: Sequence[str], month: str, amount: str, shift_months: int) -> DataFrame:
    """Movement over a quarter or a year: both sides kept, with amount bands of each."""
    pair = shifted_pair(df, keys, month, [amount], shift_months, "full")
    p, n = F.coalesce(f"then_{amount}", F.lit(0.0)), F.coalesce(f"later_{amount}", F.lit(0.0))
    kind = (
        F.when(F.col(f"then_{amount}").isNull(), NEW).when((n == 0) & (F.abs(p) > 0), CHURN)
        .when((n < p) & (n > 0), CONTRACTION).when(n > p, EXPANSION).when(n == p, SAME)
    )
    return pair.select(
        *keys, F.col("later_month").alias(month), p.alias("prior_amount"), n.alias("current_amount"),
        amount_band(p).alias("prior_band"), amount_band(n).alias("current_band"), kind.alias("change_type"),
        F.when(F.col(f"then_{amount}").isNull(), n).otherwise(F.lit(0.0)).alias("new_amount"),
        F.when((n == 0) & (p != 0), -p).otherwise(F.lit(0.0)).alias("churn_amount"),
        F.when(n > 0, F.least(n, p)).otherwise(F.lit(0.0)).alias("gross_retention"),
    )


def cohort(df: DataFrame, key: str, date: str, unit: str = "month") -> DataFrame:
    """First period of every entity beside its rows, and the periods passed since.

    Aggregated first and joined back, so a hot entity is combined on the map side.
    """
    first = df.groupBy(key).agg(F.min(date).alias("__first"))
    out = df.join(first, key)
    return out.withColumn(f"cohort_{unit}", F.trunc("__first", unit)).drop("__first")


def segment_by_amount_and_rank(df: DataFrame, amount: str, ranks: Sequence[int], bands: Sequence[float]) -> DataFrame:
    """Amount band and rank band of rows.

    The rank is the count of larger values, taken over value bins, so no task sorts the whole table.
    """
    below = ordered.with_cumulative_count(df, [], amount)
    below = below.select(amount, (F.col("__total") - F.col("__below") - F.col("__n") + 1).alias("amount_rank"))
    out = df.join(below, amount, "left")
    rank_band = F.lit(None).cast("string")
    for r in sorted(ranks, reverse=True):
        rank_band = F.when(F.col("amount_rank") <= r, F.lit(f"Top {r}")).otherwise(rank_band)
    band = F.lit(f"< {bands[0]:g}")
    for b in sorted(bands):
        band = F.when(F.col(amount) >= b, F.lit(f">= {b:g}")).otherwise(band)
    return out.select("*", F.coalesce(rank_band, F.lit("Other")).alias("rank_band"), band.alias("amount_band"))


def available_to_renew(terms: DataFrame, name: str, version: str, block: ordered.Block = None, look_ahead: int = 14) -> DataFrame:
    """Terms that come up for renewal.

    Wants ``term_start, term_end, ramp_id``. A term outside a ramp is a duplicate when the next one outside a ramp
    starts in the same month. Of the others a version is left out when the next one repeats its start month, end
    month or fiscal end year, the second next its end month, or any of the next ``look_ahead`` starts earlier (it was
    backed out). The newest version per term end counts, and the segments of one ramp are merged to the ramp's first
    start and last end. The look-ahead works over blocks of versions, so a subscription with very many versions is spread.
    """
    block = ordered.cut(terms, [name], [version]) if block is None else block
    start_month, end_month = F.trunc("term_start", "month"), F.trunc("term_end", "month")
    end_year = fiscal_attributes(F.col("term_end"))["fiscal_year"]
    alone = ordered.with_next(terms.where(F.col("ramp_id").isNull()), [name], [version], block, {"__next_start": start_month})
    alone = alone.where(~F.coalesce(F.col("__next_start") == start_month, F.lit(False))).drop("__next_start")
    single = alone.unionByName(terms.where(F.col("ramp_id").isNotNull()))
    ahead = ordered.with_next_rows(single, [name], [version], block, {"s": start_month, "e": end_month, "y": end_year}, look_ahead, "__ahead")
    nxt, second = F.get("__ahead", F.lit(0)), F.get("__ahead", F.lit(1))
    no = F.lit(False)
    superseded = (
        F.coalesce(nxt["e"] == end_month, no) | F.coalesce(second["e"] == end_month, no) | F.coalesce(nxt["y"] == end_year, no)
        | F.coalesce(nxt["s"] == start_month, no) | F.exists("__ahead", lambda r: F.coalesce(r["s"] < start_month, no))
    )
    kept = ahead.withColumn("__gone", superseded).where(~F.col("__gone")).drop("__gone", "__ahead")
    last = latest_per_key(kept, [name, "term_end"], [F.col("ramp_id").asc_nulls_last(), F.col(version).desc()])
    ramps = last.where(F.col("ramp_id").isNotNull()).groupBy("ramp_id").agg(
        F.min("term_start").alias("__rs"), F.max("term_end").alias("__re"))
    out = last.join(ramps, "ramp_id", "left").where(F.col("ramp_id").isNull() | (F.col("__re") == F.col("term_end")))
    return out.select(*terms.columns, F.coalesce("__rs", "term_start").alias("renewal_term_start"),
                      F.coalesce("__re", "term_end").alias("renewal_term_end"))


def renewal_amounts(renewals: DataFrame, charges: DataFrame, version: str) -> DataFrame:
    """Amount up for renewal: charges of the version that end with its term, empty charges left out."""
    live = charges.where(F.col("charge_start") != F.col("charge_end"))
    folded = live.groupBy(version, F.col("charge_end").alias("term_end")).agg(F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"))
    return renewals.join(folded, [version, "term_end"])


def retention_labels(df: DataFrame) -> DataFrame:
    """Labels of a retained amount (inferred names): what happened, why, and the change of plan and seats.

    Wants ``then_`` and ``later_`` columns of amount, quantity and tier; a missing later side counts as zero.
    """
    a0, a1 = F.col("then_amount"), F.coalesce("later_amount", F.lit(0.0))
    q0, q1 = F.col("then_quantity"), F.coalesce("later_quantity", F.lit(0.0))
    t0, t1 = F.col("then_tier"), F.col("later_tier")
    step = ratio(a1, q1) - ratio(a0, q0)
    gone, seats, tier, price = a1 == 0, q0 != q1, t0 != t1, F.coalesce(F.abs(step) > 0.005, F.lit(False))
    reason = (F.when(gone, "Cancellation").when(a1 == a0, "No Change").when(tier & seats, "Product and Seat Change").when(tier, "Product Change")
              .when(seats & price, "Price and Seat Change").when(seats, "Seat Change").otherwise("Price Change"))
    return df.select(
        "*", change_type(a1, a0, F.lit(2)).alias("retention_type"), reason.alias("retention_reason"),
        F.when(gone, "Cancelled").when(t1 > t0, "Upgraded").when(t1 < t0, "Downgraded").otherwise("Maintained").alias("plan_change"),
        F.when(gone, "Cancelled").when(q1 > q0, "Expanded").when(q1 < q0, "Contracted").otherwise("Maintained").alias("seat_change"),
        F.when(gone, "Full Churn").when(a1 < a0, "Partial Churn").alias("churn_type"),
        F.when(a1 > a0, F.when(t1 > t0, "Upsell").otherwise("Seat or Price Growth")).alias("growth_type"), step.alias("price_per_seat_change"))


def link_records(left: DataFrame, right: DataFrame, left_id: str, passes: Sequence[tuple[str, Column]],
                 tie_break: Sequence[Column]) -> DataFrame:
    """Match records through ordered rule passes; the first pass that matches wins, ties go by ``tie_break``.

    Each pass is an equi-join with an extra condition; the winner is picked by rank with a per-task cut.
    """
    found = None
    for i, (label, cond) in enumerate(passes, 1):
        hit = left.join(right, cond).withColumn("link_pass", F.lit(i)).withColumn("link_rule", F.lit(label))
        found = hit if found is None else found.unionByName(hit)
    return latest_per_key(found, [left_id], [F.col("link_pass"), *tie_break])


def revenue_waterfall(schedule: DataFrame, created: str, period: str, amount: str, functional_rate: Column,
                      reporting_rate: Column) -> DataFrame:
    """Scheduled amounts as seen from every period between creation and posting, in three currencies.

    The as-of periods are generated per row instead of by a range join against the calendar.
    """
    seen = F.when(F.col(created) <= F.col(period), F.sequence(created, period, F.expr("INTERVAL 1 MONTH")))
    out = schedule.select("*", F.explode(seen).alias("as_of_period"))
    functional = F.col(amount) * functional_rate
    return out.select("*", F.col(amount).alias("transactional_amount"), functional.alias("functional_amount"),
                      (functional * reporting_rate).alias("reporting_amount"))


def snapshot_pick(df: DataFrame, date: str, rules: Sequence[tuple[dt.date, dt.date, int]]) -> DataFrame:
    """One slice per month: the month's n-th day, n by date range (start, end, n), ends excluded."""
    d = F.col(date)
    hit = F.lit(False)
    for a, b, n in rules:
        hit = hit | ((d >= F.lit(a)) & (d < F.lit(b)) & (F.dayofmonth(d) == n))
    return df.where(hit)
