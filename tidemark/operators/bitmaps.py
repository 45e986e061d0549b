"""Exact distinct counts that can be added up: one bit per id, in bitmaps of 32,768 bits.

A union of bitmaps counts an id once, whatever was united, so one table of bitmaps answers every level, group and window above its grain. A
group with n ids among the first N numbers has at most N / 32,768 bitmaps of 4 KB, so ids are numbered without gaps first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ordered


def numbers(df: DataFrame, column: str) -> DataFrame:
    """``column, number``: the distinct values of a column that are not NULL, numbered from 1 in their order (1 to 32,768 are the first bitmap)."""
    ids = df.where(F.col(column).isNotNull()).select(column).distinct()
    return ordered.with_row_index(ids, [], [column], None, "number")


def numbered(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not NULL, with its ``number``."""
    return df.join(numbers(df, column), column)


def table(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``keys, bucket, bitmap``: the numbers that occur under each key. Bits are set before the shuffle, so a number is never sent."""
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def united(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same at a coarser grain."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct numbers under each key, over however many rows of bitmaps."""
    return united(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
