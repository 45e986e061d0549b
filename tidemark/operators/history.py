"""Effective-dated history: building, collapsing, sampling and joining it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators import ordered
from tidemark.operators.calendar import expand_interval
from tidemark.operators.keys import latest_per_key
from tidemark.session import dealt


def collapse_scd(df: DataFrame, keys: Sequence[str], values: Sequence[str], start: str, end: str, block: ordered.Block = None) -> DataFrame:
    """Merge consecutive validity rows that carry equal values; a value that comes back later is a new row.

    ``start`` must be unique per key. Two rows are consecutive when the later starts where the earlier ends. The
    previous row and the island number are carried over blocks, so a key with a long history is spread.
    """
    def opens(prev):
        out = F.coalesce(prev["__end"] != F.col(start), F.lit(True))
        for v in values:
            out = out | ~F.col(v).eqNullSafe(prev[v])
        return out

    islands = ordered.with_islands(df, keys, [start], block, {**{v: v for v in values}, "__end": end}, opens, "__island")
    open_end = F.max(F.col(end).isNull())
    return (
        islands.groupBy(*keys, "__island", *values)
        .agg(F.min(start).alias(start), F.when(~open_end, F.max(end)).alias(end), F.count("*").alias("merged_rows"))
        .drop("__island")
    )


def asof_scd(fact: DataFrame, dim: DataFrame, key: str, ts: str, attrs: Sequence[str], start: str, end: str | None,
             block: ordered.Block = None) -> DataFrame:
    """Attributes valid at the fact's time, [start, end); no end means the latest version at or before it.

    Facts and versions are laid on one time line per key and the last version is filled forward over its blocks. A
    hot key thus costs facts + versions rows, never facts x versions.
    """
    at = "__at"
    ver = F.struct(*[F.col(a) for a in attrs], *([F.col(end).alias("__until")] if end else []))
    kind = fact.schema[ts].dataType
    d = dim.where(F.col(key).isNotNull()).select(key, F.col(start).cast(kind).alias(at), F.lit(0).alias("__side"), ver.alias("__ver"))
    f = fact.select(key, F.col(ts).alias(at), F.lit(1).alias("__side"), F.struct(*[F.col(x) for x in fact.columns]).alias("__fact"))
    line = d.unionByName(f, allowMissingColumns=True)
    filled = ordered.with_last_known(line, [key], [at, "__side"], block, {"__now": "__ver"})
    live = F.col("__now").isNotNull()
    if end:
        live = live & (F.col("__now.__until").isNull() | (F.col(at) < F.col("__now.__until")))
    return filled.where(F.col("__side") == 1).select(
        "__fact.*", *[F.when(live, F.col(f"__now.{a}")).alias(a) for a in attrs]
    )


def next_match(requests: DataFrame, actions: DataFrame, keys: Sequence[str], at: str, values: Sequence[str],
               block: ordered.Block = None) -> DataFrame:
    """First action at or after each request of the same keys, by filling backward on one time line."""
    act = F.struct(F.col(at).alias("__when"), *[F.col(v) for v in values])
    a = actions.select(*keys, F.col(at), F.lit(1).alias("__side"), act.alias("__act"))
    r = requests.select(*keys, F.col(at), F.lit(0).alias("__side"), F.struct(*[F.col(x) for x in requests.columns]).alias("__req"))
    line = a.unionByName(r, allowMissingColumns=True)
    filled = ordered.with_next_known(line, keys, [at, "__side"], block, {"__hit": "__act"})
    return filled.where(F.col("__side") == 0).select(
        "__req.*", F.col("__hit.__when").alias(f"matched_{at}"), *[F.col(f"__hit.{v}").alias(f"matched_{v}") for v in values]
    )


def snapshot_series(scd: DataFrame, start: str, end: str, horizon: dt.date, unit: str = "month", name: str = "snapshot_date") -> DataFrame:
    """Every version on every first-of-month (or day) on which it is valid, [start, end)."""
    if unit == "day":
        return expand_interval(scd, start, end, "day", horizon, name)
    first = F.trunc(F.col(start), "month")
    first = F.when(first < F.col(start), F.add_months(first, 1)).otherwise(first)
    last = F.coalesce(F.date_sub(F.col(end), 1), F.lit(horizon))
    dates = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 MONTH")))
    return scd.select("*", F.explode(dates).alias(name))


def scd_latest_state(df: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """Newest row of every id; an id missing from the newest load counts as deleted since."""
    last = latest_per_key(df, [key], [F.col(loaded_at).desc()])
    newest = df.agg(F.max(loaded_at).alias("m")).scalar()
    return last.withColumn("is_deleted", F.col(loaded_at) < newest)


def scd_type_2(df: DataFrame, key: str, values: Sequence[str], loaded_at: str, block: ordered.Block = None) -> DataFrame:
    """Loads of full slices to validity rows: a new version whenever a tracked value changes."""
    block = ordered.cut(df, [key], [loaded_at]) if block is None else block  # one sample for both steps
    nxt = ordered.with_next(df, [key], [loaded_at], block, {"valid_to": loaded_at})
    rows = nxt.select(key, *values, F.col(loaded_at).alias("valid_from"), "valid_to")
    return collapse_scd(rows, [key], values, "valid_from", "valid_to", block if isinstance(block, ordered.Cut) else None)


def versions_to_history(audit: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: ordered.Block = None) -> DataFrame:
    """Change rows per (id, field) with the previous value and time, and the time of the next change."""
    at = order[0]
    block = ordered.cut(audit, keys, order) if block is None else block
    prev = ordered.with_previous(audit, keys, order, block, {"previous_value": value, "previous_at": at})
    return ordered.with_next(prev, keys, order, block, {"valid_to": at})


def _years_touched(start: Column, end: Column) -> Column:
    """Years that [start, end) touches."""
    last = F.date_sub(end, 1)
    return F.when(start <= last, F.sequence(F.year(start), F.year(last)))


def _without_gaps(scd: DataFrame, key: str, value: str, start: str, end: str, first: Column, horizon_end: Column) -> DataFrame:
    """Validity rows with explicit NULL-valued rows for the time before, between and after them.

    Versions of a key are at most one per day, so the window is bounded by the calendar.
    """
    w = W.partitionBy(key).orderBy(start)
    until, nxt = F.coalesce(end, horizon_end), F.coalesce(F.lead(start).over(w), horizon_end)
    none = F.lit(None).cast(scd.schema[value].dataType)
    piece = lambda v, a, b: F.struct(v.alias(value), a.alias("__from"), b.alias("__to"))
    rows = scd.select(key, value, F.col(start).alias("__s"), until.alias("__u"), nxt.alias("__n"), F.row_number().over(w).alias("__rn"))
    pieces = F.array_compact(F.array(
        piece(F.col(value), F.col("__s"), F.col("__u")),
        F.when(F.col("__u") < F.col("__n"), piece(none, F.col("__u"), F.col("__n"))),
        F.when((F.col("__rn") == 1) & (first < F.col("__s")), piece(none, first, F.col("__s")))))
    return rows.select(key, F.explode(pieces).alias("p")).select(key, "p.*")


def state_intervals(entities: DataFrame, labels: DataFrame, key: str, opened: str, closed: str, horizon: dt.date,
                    label: str, label_from: str, label_to: str) -> DataFrame:
    """Intervals ``[open_from, open_to)`` in which an entity is open under one label (NULL when there is none), cut at months.

    Entities and label versions meet in years by equality, the versions of a key and year as one array (they are bounded by the calendar); months are
    made afterwards, inside the row, and never travel.
    """
    end_of_time = F.lit(horizon + dt.timedelta(days=1))
    e = entities.withColumns({"__a": F.col(opened), "__b": F.coalesce(closed, end_of_time)})
    first = entities.agg(F.min(opened).alias("m")).scalar()
    lab = _without_gaps(labels, key, label, label_from, label_to, first, end_of_time)
    lab = lab.select(key, label, "__from", "__to", F.explode(_years_touched(F.col("__from"), F.col("__to"))).alias("__year"))
    lab = lab.groupBy(key, "__year").agg(F.collect_list(F.struct(F.col(label).alias("label"), "__from", "__to")).alias("__versions"))
    met = e.withColumn("__year", F.explode(_years_touched(F.col("__a"), F.col("__b")))).join(lab, [key, "__year"], "left")
    from_month = F.greatest(F.trunc("__a", "month"), F.make_date("__year", F.lit(1), F.lit(1)))
    to_month = F.least(F.trunc(F.date_sub("__b", 1), "month"), F.make_date("__year", F.lit(12), F.lit(1)))
    binned = met.withColumn("__bin", F.explode(F.sequence(from_month, to_month, F.expr("INTERVAL 1 MONTH"))))
    until = F.add_months("__bin", 1)
    live = F.filter("__versions", lambda v: (v["__from"] < v["__to"]) & (v["__from"] < until) & (v["__to"] > F.col("__bin")))
    j = binned.withColumn("__v", F.explode_outer(live))
    a = F.greatest("__a", "__bin", F.coalesce("__v.__from", "__bin"))
    b = F.least("__b", until, F.coalesce("__v.__to", "__b"))
    return j.where(a < b).select(*[F.col(x) for x in entities.columns], F.col("__v.label").alias(label), a.alias("open_from"), b.alias("open_to"))


def state_on_day(entities: DataFrame, labels: DataFrame, key: str, opened: str, closed: str, horizon: dt.date,
                 label: str, label_from: str, label_to: str) -> DataFrame:
    """Every day an entity is open, with its age in days and the label valid that day (NULL when there is none).

    The days are generated after the last shuffle; an entity-day never travels. To count them, see ``calendar.open_per_day``.
    """
    pieces = state_intervals(entities, labels, key, opened, closed, horizon, label, label_from, label_to)
    days = F.sequence("open_from", F.date_sub("open_to", 1), F.expr("INTERVAL 1 DAY"))
    out = pieces.select(*[F.col(x) for x in entities.columns], label, F.explode(days).alias("day"))
    return out.withColumn("age_days", F.datediff("day", opened))


def union_partitions(parts: Sequence[DataFrame], key: str, loaded_at: str, since) -> DataFrame:
    """Union of same-shaped period tables, rows since a date, newest copy of every id."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.where(F.col(loaded_at) >= F.lit(since)) for p in parts])
    return latest_per_key(rows, [key], [F.col(loaded_at).desc()])


def merge_histories(a: DataFrame, b: DataFrame, key: str, start: str, a_values: Sequence[str], b_values: Sequence[str],
                    block: ordered.Block = None, cut_over: dt.date | None = None) -> DataFrame:
    """Two systems' effective-dated rows on one line: a row from each date on which the last known values of both change.

    With ``cut_over`` the first system holds until the day before and the second from that date on, with what it knew by then; the other's values are
    NULL. A run of equal values starts where the values before differ and ends where the next run starts, so the runs alone are numbered and no row
    needs its neighbour's date.
    """
    values = [*a_values, *b_values]
    a, b = a.select(key, start, *a_values), b.select(key, start, *b_values)
    if cut_over:
        at = F.lit(cut_over).cast(a.schema[start].dataType)
        ended = a.select(key).distinct().select(key, at.alias(start))  # the day on which the first system says no more
        a = a.where(F.col(start) < at).unionByName(ended, allowMissingColumns=True)
        b = b.groupBy(key, start).agg(*[F.max(v).alias(v) for v in b_values]).withColumn("__from", F.col(start)).withColumn(start, F.greatest(start, at))
        b = b.groupBy(key, start).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("__from"))).alias(v) for v in b_values])
    line = a.unionByName(b, allowMissingColumns=True)
    days = line.groupBy(key, start).agg(*[F.max(v).alias(v) for v in values])
    block = ordered.cut(days, [key], [start]) if block is None else block
    if isinstance(block, ordered.Cut) and block.splits is None:
        days = dealt(days, key)  # once for all windows that follow
    filled = ordered.with_last_known(days, [key], [start], block, {f"known_{v}": v for v in values})
    known = {v: F.col(f"known_{v}") for v in values}
    if cut_over:
        known = {v: F.when((F.col(start) < at) if v in a_values else (F.col(start) >= at), x) for v, x in known.items()}
    filled = filled.select(key, start, *[x.alias(v) for v, x in known.items()])

    def opens(prev):
        return reduce(lambda x, y: x | y, [~F.col(v).eqNullSafe(prev[v]) for v in values])

    runs = ordered.with_islands(filled, [key], [start], block, {v: v for v in values}, opens, "__run")
    runs = runs.groupBy(key, "__run", *values).agg(F.min(start).alias(start))
    # a run is one row now; its end is the start of the next run
    return ordered.with_next(runs, [key], [start], block, {"valid_to": start}).drop("__run")
