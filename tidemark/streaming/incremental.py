"""Incremental upkeep of a table, in batch form: what to read, and how new rows meet the old ones.

Every function returns the new contents or the rows to add; nothing overwrites a path that is being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(target: DataFrame, ts: str) -> Column | None:
    """The greatest value of a column as a literal, so that a filter by it reaches the scan of the source; None for an empty table."""
    text = target.agg(F.max(ts).cast("string")).first()[0]
    return None if text is None else F.lit(text).cast(target.schema[ts].dataType)


def append_since(source: DataFrame, target: DataFrame, ts: str, inclusive: bool = False) -> DataFrame:
    """Source rows newer than the newest in the target; all rows while the target is empty."""
    mark = newest(target, ts)
    if mark is None:
        return source
    return source.where((F.col(ts) >= mark) if inclusive else (F.col(ts) > mark))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in the new ones, plus the new ones. Columns that only one side has are kept."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def delete_insert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every group of the keys that the new rows touch is replaced as a whole."""
    return upsert(old, new, keys)


def merge_sum(old: DataFrame, new: DataFrame, keys: Sequence[str], sums: Sequence[str], maxes: Sequence[str] = ()) -> DataFrame:
    """Upsert that adds numeric columns of an existing key and keeps the greatest of others."""
    both = old.unionByName(new)
    return both.groupBy(*keys).agg(*[F.sum(x).alias(x) for x in sums], *[F.max(x).alias(x) for x in maxes])


def event_counts(events: DataFrame, event_id: str, loaded_at: str, valid: Column) -> DataFrame:
    """Valid event ids with how often and when last they were loaded."""
    return events.where(valid).groupBy(event_id).agg(F.count("*").alias("event_count"), F.max(loaded_at).alias("last_loaded_at"))


def only_once(events: DataFrame, counts: DataFrame, event_id: str, loaded_at: str | None = None) -> DataFrame:
    """Events whose id was loaded exactly once; ids loaded more often are left out entirely.

    With ``loaded_at`` a row must also be the one the count was taken at, so a copy that came later is dropped.
    """
    single = counts.where(F.col("event_count") == 1).select(F.col(event_id), F.col("last_loaded_at").alias("__at"))
    j = events.join(single, event_id)
    if loaded_at:
        j = j.where(F.col(loaded_at) == F.col("__at"))
    return j.drop("__at")


def touched(all_rows: DataFrame, since: Column, ts: str, keys: Sequence[str]) -> DataFrame:
    """All rows, however old, of the keys that have a row newer than a mark: late events pull their session back in."""
    fresh = all_rows.where(F.col(ts) > since).select(*keys).distinct()
    return all_rows.join(fresh, list(keys), "left_semi")


def lookback(source: DataFrame, target: DataFrame, ts: str, days: int) -> DataFrame:
    """Source rows from ``days`` before the target's newest on; all rows while the target is empty."""
    mark = newest(target, ts)
    return source if mark is None else source.where(F.col(ts) >= F.date_sub(F.to_date(mark), days).cast(source.schema[ts].dataType))


def rolling_window(df: DataFrame, ts: str, unit: str, n: int, as_of: Column) -> DataFrame:
    """Rows not older than n days or months before a date."""
    floor = F.add_months(as_of, -n) if unit == "month" else F.date_sub(as_of, n)
    return df.where(F.col(ts) >= floor)


def current_only(df: DataFrame, flag: str) -> DataFrame:
    """Rows not superseded."""
    return df.where(F.col(flag))


def unmapped(source: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that have no mapping yet."""
    return source.select(*keys).distinct().join(mapped.select(*keys), list(keys), "left_anti")


def accrete(slices: DataFrame, today: DataFrame, snapshot_col: str) -> DataFrame:
    """One slice per day: today's slice replaces an earlier run of the same day."""
    day = today.select(snapshot_col).distinct()
    return slices.join(day, snapshot_col, "left_anti").unionByName(today)


def write_month_partitions(df: DataFrame, ts: str, path: str) -> None:
    """Table partitioned by month; only the months present in the rows are replaced."""
    out = df.withColumn("month", F.date_format(ts, "yyyy-MM"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
