"""Cost allocation, receivables and ledgers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import ratio
from tidemark.operators import ordered
from tidemark.operators.calendar import densify
from tidemark.operators.intervals import overlaps, points_in


def allocation_ratio(df: DataFrame, within: Sequence[str], keys: Sequence[str], measure: str) -> DataFrame:
    """Share of a measure per key within its partition; the partition total is an aggregate joined back."""
    g = df.groupBy(*within, *keys).agg(F.sum(measure).alias("total"))
    g = ordered.with_totals(g, within, {"__all": F.sum("total")})
    return g.select(*within, *keys, "total", ratio("total", "__all").alias("share"))


def apply_mapping_by_priority(facts: DataFrame, mapping: DataFrame, patterns: Sequence[Sequence[str]], keys: Sequence[str],
                              percent: str, measures: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Measures split by the most specific mapping that matches; facts without one keep their whole amount.

    A mapping row leaves some keys NULL (any value). ``patterns`` lists the sets of filled keys in order of
    precedence. The winner is found once per distinct key combination of the facts: each combination tries every
    pattern with its other keys blanked, in one null-safe equi-join, so neither facts nor wildcards are compared pair
    by pair.
    """
    def masked(rank: int, used: Sequence[str]) -> Column:
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in used], F.lit(True))
        wild = [F.col(k).alias(f"__{k}") if k in used else F.lit(None).cast(facts.schema[k].dataType).alias(f"__{k}") for k in keys]
        return F.when(known, F.struct(F.lit(rank).alias("__rank"), *wild))

    tries = F.array_compact(F.array(*[masked(n, used) for n, used in enumerate(patterns)]))
    combos = facts.select(*keys).distinct().select(*keys, F.explode(tries).alias("t")).select(*keys, "t.*")
    rules = mapping.select(*[F.col(k).alias(f"__m_{k}") for k in keys], percent, *outputs)
    same = reduce(lambda a, b: a & b, [F.col(f"__{k}").eqNullSafe(F.col(f"__m_{k}")) for k in keys])
    found = combos.join(rules, same).select(*keys, "__rank", percent, *outputs)
    first = F.rank().over(W.partitionBy(*keys).orderBy("__rank"))
    winners = found.withColumn("__first", first).where("__first = 1").drop("__first", "__rank")
    share = F.coalesce(percent, F.lit(1.0))
    rest = [x for x in facts.columns if x not in measures]
    winners = winners.withColumnsRenamed({k: f"__w_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in keys])
    return facts.join(winners, same, "left").select(*rest, *outputs, *[(F.col(m) * share).alias(m) for m in measures])


def overlap_attribution(intervals: DataFrame, meters: DataFrame, key: str, interval_id: str, credits: str) -> DataFrame:
    """Metered cost split over the intervals that overlap it, by overlapped time.

    Both sides carry ``start`` and ``end``. They meet in cells of hours, days and longer (``intervals.overlaps``), a year-long one in 26 at most.
    An interval with exactly the meter's bounds, or with its start and an earlier end, has no duration: the classes that
    end within the meter start strictly after or before it.
    """
    hour = lambda x: F.floor(F.unix_seconds(F.col(x).cast("timestamp")) / 3600)
    a = intervals.select(key, interval_id, "start", "end")
    b = meters.select(key, credits, F.col("start").alias("meter_start"), F.col("end").alias("meter_end"))
    j = overlaps(a, b, [key], (hour("start"), hour("end")), (hour("meter_start"), hour("meter_end"))).where(
        (F.col("meter_end") > F.col("start")) & (F.col("meter_start") < F.col("end")))
    s, e, ms, me = (F.col(x) for x in ("start", "end", "meter_start", "meter_end"))
    millis = lambda x, y: F.timestamp_diff("MILLISECOND", x, y)
    spent = (F.when((s >= ms) & (e > me), millis(s, me)).when((s < ms) & (e > me), millis(ms, me))
             .when((s < ms) & (e <= me), millis(ms, e)).when((s > ms) & (e < me), millis(s, e)))
    j = j.select(key, interval_id, "start", "end", "meter_start", credits, spent.alias("overlap_ms"))
    j = ordered.with_totals(j, [key, "meter_start"], {"total_ms": F.sum("overlap_ms")})
    share = ratio("overlap_ms", "total_ms")
    return j.select(key, interval_id, "meter_start", "overlap_ms", share.alias("fraction"), (share * F.col(credits)).alias("attributed"))


def unpivot_allocation(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def aging_bucket(days: Column) -> Column:
    return (F.when(days <= 0, "1 -- Current").when(days <= 30, "2 -- 1 to 30 days past due").when(days <= 60, "3 -- 31 to 60 days past due")
            .when(days <= 90, "4 -- 61 to 90 days past due").when(days <= 120, "5 -- 91 to 120 days past due")
            .when(days > 120, "6 -- More than 120 days past due").otherwise("n/a"))


def aging_buckets(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Open invoices with days overdue, payment terms and bucket."""
    overdue = F.datediff(F.lit(as_of), "due_date")
    return invoices.where(F.col("balance") > 0).select(
        "invoice_id", F.trunc("invoice_date", "month").alias("period"), "balance", "amount",
        F.datediff("due_date", "invoice_date").alias("payment_terms"), overdue.alias("days_overdue"), aging_bucket(overdue).alias("aging_bucket"))


def days_bucket(x: Column, edges: Sequence[int]) -> Column:
    """Label of the range between two edges a number falls into."""
    out = F.when(x <= edges[0], f"[0-{edges[0]}]")
    for a, b in zip(edges, edges[1:]):
        out = out.when(x <= b, f"[{a + 1}-{b}]")
    return out.otherwise(f"[{edges[-1]}+]")


def balance_rollforward(feeds: Mapping[str, DataFrame], flows: Sequence[str], gate: str, aged: str) -> DataFrame:
    """Monthly feeds on one line with running ending balance and the previous month's as starting balance.

    Feeds carry ``period`` and ``amount``; ``flows`` are signed feeds that move the balance; months without the
    ``gate`` feed are left out. The feeds are stacked and folded by month once instead of a chain of full joins.
    """
    stacked = reduce(DataFrame.unionByName, [f.select("period", F.lit(n).alias("__feed"), "amount") for n, f in feeds.items()])
    table = stacked.groupBy("period").agg(*[F.coalesce(F.sum(F.when(F.col("__feed") == n, F.col("amount"))), F.lit(0.0)).alias(n) for n in feeds])
    table = table.where(F.col(gate) > 0)
    w = W.orderBy("period")  # months only
    moved = sum((F.col(f) for f in flows), F.lit(0.0))
    out = table.withColumn("ending_balance", F.sum(moved).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return out.select("*", F.coalesce(F.lag("ending_balance").over(w), F.lit(0.0)).alias("starting_balance"),
                      F.coalesce(F.lag(aged).over(w), F.lit(0.0)).alias(f"starting_{aged}"))


def dso_cei(balances: DataFrame, days: int = 30) -> DataFrame:
    """Days sales outstanding and collection effectiveness of monthly balances.

    Wants ``starting_aged, aged, current, billing``.
    """
    s, a, c, b = (F.col(x) for x in ("starting_aged", "aged", "current", "billing"))
    return balances.select("period", F.round(ratio((s + a) / 2, b) * days, 0).alias("dso"),
                           F.round(ratio(s + b - a, s + b - c) * 100, 2).alias("cei"))


def cumulative_balance_fx(lines: DataFrame, keys: Sequence[str], period: str, amount: str, rates: DataFrame, kind: str,
                          income_kind: str, retained_kind: str) -> DataFrame:
    """Balance of every account kind at every period from its first on, in two currency bases; income is rolled into
    retained earnings.

    Monthly sums are made dense and accumulated by a window over months, instead of joining every line to all later
    periods. ``rates(period, average_rate, closing_rate)``.
    """
    rolled = lines.withColumn(kind, F.when(F.col(kind) == income_kind, retained_kind).otherwise(F.col(kind)))
    month = rolled.groupBy(*keys, kind, period).agg(F.sum(amount).alias(amount))
    last = lines.agg(F.max(period).alias("m")).scalar()
    ends = month.groupBy(*keys, kind).agg(F.min(period).alias("__a"))
    spine = ends.select(*keys, kind, F.explode(F.sequence("__a", last, F.expr("INTERVAL 1 MONTH"))).alias(period))
    dense = spine.join(month, [*keys, kind, period], "left").join(rates, period, "left")
    w = W.partitionBy(*keys, kind).orderBy(period).rowsBetween(W.unboundedPreceding, 0)
    base = F.coalesce(amount, F.lit(0.0))
    return dense.select(*keys, kind, period, F.sum(base).over(w).alias("balance"), F.sum(base * F.col("average_rate")).over(w).alias("balance_at_average"),
                        (F.sum(base).over(w) * F.col("closing_rate")).alias("balance_at_closing"))


def monthly_ledger(payments: DataFrame, period: str, kind: str, amount: str) -> DataFrame:
    """Payments per type and month with the share of the month's total."""
    return allocation_ratio(payments, [period], [kind], amount)


def collections_matrix(payments: DataFrame) -> DataFrame:
    """Payments by month paid and month invoiced, with the lag in months."""
    p, b = F.trunc("payment_date", "month"), F.trunc("invoice_date", "month")
    g = payments.groupBy(p.alias("payment_month"), b.alias("invoice_month")).agg(F.sum("amount").alias("collected"), F.count("*").alias("payments"))
    lag = (F.year("payment_month") - F.year("invoice_month")) * 12 + F.month("payment_month") - F.month("invoice_month")
    return g.withColumn("months_to_pay", lag)


def discount_analysis(items: DataFrame, invoice: str, order: Sequence[str], block: ordered.Block, list_price: Column, price: Column,
                      quantity: str, term_days: Column) -> DataFrame:
    """List against realised price per unit, change of quantity from the previous item of the invoice, and the amount
    normalised to a year."""
    prev = ordered.with_previous(items, [invoice], order, block, {"previous_quantity": quantity})
    return prev.select("*", list_price.alias("list_price"), price.alias("realised_price"), (F.lit(1.0) - ratio(price, list_price)).alias("discount_rate"),
                       (F.col(quantity) - F.coalesce("previous_quantity", F.lit(0))).alias("delta_quantity"),
                       (price * F.col(quantity) * F.lit(365.0) / F.greatest(term_days, F.lit(1))).alias("yearly_amount"))


def effective_days(start: Column, end: Column) -> Column:
    """Days of a term, a leap day inside it (both ends included) not counted, so that a year is always 365."""
    years = F.sequence(F.year(start), F.year(end))
    leap = lambda y: ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    inside = F.exists(years, lambda y: leap(y) & F.date_add(F.make_date(y, F.lit(2), F.lit(28)), 1).between(start, end))
    return F.datediff(end, start) - F.when(inside, 1).otherwise(0)


def three_way_reconcile(a: DataFrame, b: DataFrame, c: DataFrame, key: str) -> DataFrame:
    """Full outer bridge of three systems by key, with the match status."""
    tag = lambda d, n: d.select(key, F.lit(True).alias(n), *[x for x in d.columns if x != key])
    j = tag(a, "in_a").join(tag(b, "in_b"), key, "full").join(tag(c, "in_c"), key, "full")
    has = [F.coalesce(F.col(n), F.lit(False)) for n in ("in_a", "in_b", "in_c")]
    status = (F.when(has[0] & has[1] & has[2], "all three").when(has[0] & has[1], "a and b").when(has[0] & has[2], "a and c")
              .when(has[1] & has[2], "b and c").when(has[0], "a only").when(has[1], "b only").otherwise("c only"))
    return j.withColumn("match_status", status).drop("in_a", "in_b", "in_c")


def coalesce_sources(sources: Sequence[tuple[str, DataFrame]], keys: Sequence[str], value: str) -> DataFrame:
    """One value per key from several feeds in order of preference, labelled with the feed it came from."""
    rows = reduce(DataFrame.unionByName, [
        d.where(F.col(value).isNotNull()).select(*keys, F.lit(rank).alias("__r"), F.lit(n).alias("source"), value)
        for rank, (n, d) in enumerate(sources)])
    best = F.min_by(F.struct("source", value), F.struct("__r", value))
    return rows.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def ip_to_region(ips: DataFrame, ip_number: str, ranges: DataFrame, first: str, last: str) -> DataFrame:
    """Range of every address. Ranges are covered by networks of /32, /24, /16 and /8, and an address looks up its own four."""
    return points_in(ips, ranges, [], F.col(ip_number), F.col(first), F.col(last), bits=8).drop(first, last)
