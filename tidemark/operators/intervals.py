"""Intervals of whole numbers joined by equality.

An interval is covered by aligned cells: level k has cells of ``2 ** (bits * k)`` numbers, and a run of n numbers needs at most
``2 * (2 ** bits - 1)`` cells on each of ``log2(n) / bits + 1`` levels, so at most about 2 log2(n) cells where ``bits`` is 1. A point lies in one cell of every
level, so it meets the cells of an interval by equality on (level, cell), exactly once if the interval holds it. How long an interval is hardly
matters, and a long one doesn't gather what it covers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = "array<struct<level:int,cell:bigint>>"


def _top(size: Column, bits: int) -> Column:
    """The level whose cells are at most ``size`` numbers and more than a ``2 ** bits``-th of it."""
    return F.floor((F.length(F.bin(size)) - 1) / bits).cast("int")


def cover(first: Column, last: Column, bits: int = 1) -> Column:
    """Aligned cells that together hold the numbers from ``first`` to ``last`` and no others; none if that is empty or a bound is NULL."""
    width = 1 << bits
    first, last = first.cast("long"), last.cast("long")
    down = lambda x: F.shiftleft(F.shiftright(x, bits), bits)
    named = lambda cells, k: F.transform(cells, lambda x: F.struct(k.cast("int").alias("level"), x.alias("cell")))
    none = F.array().cast("array<bigint>")

    def step(s: Column, k: Column) -> Column:
        """Takes the cells before the first aligned one and after the last, and goes one level up with the rest."""
        head = F.least(s["b"], down(s["a"] + (width - 1)) - 1)
        a = F.greatest(s["a"], head + 1)
        tail = F.greatest(a, down(s["b"] + 1))
        b = F.least(s["b"], tail - 1)
        left = F.when(s["a"] <= head, F.sequence(s["a"], head)).otherwise(none)
        right = F.when(tail <= s["b"], F.sequence(tail, s["b"])).otherwise(none)
        return F.struct(
            F.when(a <= b, F.shiftright(a, bits)).otherwise(F.lit(1).cast("long")).alias("a"),
            F.when(a <= b, F.shiftright(b + 1, bits) - 1).otherwise(F.lit(0).cast("long")).alias("b"),
            F.concat(s["out"], named(left, k), named(right, k)).alias("out"))

    start = F.struct(first.alias("a"), last.alias("b"), F.array().cast(CELLS).alias("out"))
    cells = F.aggregate(F.sequence(F.lit(0), _top(last - first + 1, bits)), start, step, lambda s: s["out"])
    return F.when(first <= last, cells).otherwise(F.array().cast(CELLS))


def ancestors(point: Column, levels: Column, bits: int = 1) -> Column:
    """The cells a number lies in, on ``levels`` (an array)."""
    point = point.cast("long")
    return F.transform(levels, lambda k: F.struct(k.cast("int").alias("level"), F.call_function("shiftright", point, (k * bits).cast("int")).alias("cell")))


def _levels(df: DataFrame, first: Column, last: Column, bits: int) -> Column:
    """All levels that covers of these intervals can use, from the longest of them."""
    longest = df.where(first <= last).agg(F.max(last.cast("long") - first.cast("long") + 1).alias("n")).select(_top(F.coalesce("n", F.lit(1)), bits).alias("n"))
    return F.sequence(F.lit(0), longest.scalar())


def points_in(points: DataFrame, ranges: DataFrame, on: Sequence[str], point: Column, first: Column, last: Column, bits: int = 1, how: str = "inner") -> DataFrame:
    """Rows of ``points`` with each row of ``ranges`` of equal ``on`` whose numbers ``first`` to ``last`` hold ``point``.

    With ``how="left_semi"`` the distinct points that lie in any. The other columns of both sides must have names of their own.
    """
    cells = ranges.select("*", F.explode(cover(first, last, bits)).alias("__at"))
    looked = points.withColumn("__levels", _levels(ranges, first, last, bits)).withColumn("__at", F.explode(ancestors(point, F.col("__levels"), bits)))
    found = looked.drop("__levels").join(cells, [*on, "__at"], how).drop("__at")
    return found.select(*points.columns).distinct() if how == "left_semi" else found


def overlaps(a: DataFrame, b: DataFrame, on: Sequence[str], a_range: tuple[Column, Column], b_range: tuple[Column, Column], bits: int = 1) -> DataFrame:
    """Every pair of rows of equal ``on`` whose ranges (first and last, both included) share a number, once.

    Of two that overlap, one starts inside the other: starts of ``a`` meet the cells of ``b``, and starts of ``b`` that are later the cells of
    ``a``. The other columns of both sides must have names of their own.
    """
    def laid(df: DataFrame, own: tuple[Column, Column], other: DataFrame, others: tuple[Column, Column], side: str) -> DataFrame:
        first, last = own
        starts = F.transform(ancestors(first, F.col("__levels"), bits), lambda x: F.struct(F.lit(side).alias("starts"), x["level"].alias("level"), x["cell"].alias("cell")))
        cells = F.transform(cover(first, last, bits), lambda x: F.struct(F.lit("b" if side == "a" else "a").alias("starts"), x["level"].alias("level"), x["cell"].alias("cell")))
        rows = df.withColumns({f"__{side}": first.cast("long"), "__levels": _levels(other, *others, bits)}).where(first <= last)
        return rows.withColumn("__at", F.explode(F.concat(starts, cells))).drop("__levels")

    met = laid(a, a_range, b, b_range, "a").join(laid(b, b_range, a, a_range, "b"), [*on, "__at"])
    return met.where((F.col("__at.starts") == "a") | (F.col("__b") > F.col("__a"))).drop("__at", "__a", "__b")
