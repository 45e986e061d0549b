"""One-to-one links between two sets of records, by evidence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import c
from tidemark.session import cut_lineage


def one_to_one(pairs: DataFrame, left: str, right: str, cost: Sequence[Column]) -> DataFrame:
    """The pairs that are taken when the cheapest comes first and each left and right record is used once.

    Equal to going through all pairs by ``cost`` (then left, then right), but in rounds: every open left record proposes to the best
    open right one, and a proposal is accepted if the right one has no better. The cheapest open pair is always accepted, so rounds end; each takes
    two map-side combined minima, and a record with very many pairs is met by aggregation alone.
    """
    best = F.struct(*[x.alias(f"__{k}") for k, x in enumerate(cost)], F.col(left).alias("__l"), F.col(right).alias("__r"))
    rows = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).withColumn("__p", best).dropDuplicates([left, right])
    rows = cut_lineage(rows)
    open_pairs, taken = rows.select(F.col(left).alias("__l"), F.col(right).alias("__r"), "__p"), []
    while True:
        of_left = open_pairs.groupBy("__l").agg(F.min("__p").alias("__p"))
        of_right = open_pairs.groupBy("__r").agg(F.min("__p").alias("__p"))
        mutual = cut_lineage(of_left.join(of_right, "__p").select("__l", "__r"))
        if mutual.isEmpty():
            break
        taken.append(mutual)
        open_pairs = cut_lineage(open_pairs.join(mutual.select("__l"), "__l", "left_anti").join(mutual.select("__r"), "__r", "left_anti"))
    links = reduce(DataFrame.unionByName, taken) if taken else open_pairs.select("__l", "__r")
    return rows.join(links, (F.col(left) == F.col("__l")) & (F.col(right) == F.col("__r"))).drop("__l", "__r", "__p")


def _slug(x: Column) -> Column:
    """Lower case, runs of spaces as one, and a hyphen for what is neither letter nor digit."""
    return F.trim(F.lower(F.regexp_replace(F.regexp_replace(x, "[ ]{2,}", " "), "[^A-Za-z0-9|]", "-")))


def amount_and_quantity(left: DataFrame, right: DataFrame, on: Sequence[str], amount: str, quantity: str, right_amount: str, name: str) -> DataFrame:
    """Candidate pairs of equal ``on`` with their evidence in points: 5 for equal amounts to the cent, 5 for the quantity in the right record's name,
    1 more if it is written there with thousands commas.

    A quantity is in a name when one of the name's numbers, read without commas, equals it. Pairs without evidence are never
    formed: records meet by amount or by quantity, each an equi-join.
    """
    cents = lambda x: F.round(F.col(x), 2).cast("decimal(18,2)")
    numbers = F.array_distinct(F.transform(F.regexp_extract_all(F.col(name), F.lit("[0-9][0-9,]*"), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("long")))
    a = left.withColumns({"__cents": cents(amount), "__quantity": c(quantity).cast("long")})
    b = right.withColumns({"__r_cents": cents(right_amount), "__numbers": numbers})
    by_amount = a.join(b, [*on]).where(F.col("__cents") == F.col("__r_cents"))
    by_quantity = a.join(b.withColumn("__number", F.explode("__numbers")), [*on]).where(F.col("__quantity") == F.col("__number")).drop("__number")
    pairs = by_amount.unionByName(by_quantity)
    written = F.trim(F.format_number("__quantity", 0))
    named = F.coalesce(F.array_contains("__numbers", F.col("__quantity")), F.lit(False))
    points = (F.when(F.col("__cents") == F.col("__r_cents"), 5).otherwise(0) + F.when(named, 5).otherwise(0)
              + F.when(named & F.contains(F.col(name), written) & F.contains(_slug(F.col(name)), _slug(written)), 1).otherwise(0))
    return pairs.withColumn("points", points).drop("__cents", "__r_cents", "__quantity", "__numbers")
