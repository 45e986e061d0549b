"""Tables kept in buckets of their key: joined and merged again and again without moving the large side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as table ``name`` below ``path``, hashed into ``buckets`` files by ``keys`` and sorted in each."""
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def upsert_bucketed(spark: SparkSession, name: str, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a bucketed table whose keys are not in ``new``, and those of ``new``. Only ``new`` is exchanged, to the table's buckets."""
    old = spark.table(name)
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def rewrite_bucketed(spark: SparkSession, name: str, new: DataFrame, keys: Sequence[str], buckets: int, path: str, into: str) -> DataFrame:
    """The merged table as the next version, ``into`` below ``path``, in the same buckets. The old version stays for its readers.

    Old rows that stay are already in their bucket's task, new ones are dealt to it, so nothing else moves.
    """
    merged = spark.table(name).join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new.repartition(buckets, *keys))
    merged.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(into)
    return spark.table(into)


def stale_rows(spark: SparkSession, fact: str, dimension: str, key: str, attrs: Sequence[str]) -> DataFrame:
    """Rows of a bucketed fact table whose stored attributes differ from those of a dimension in the same buckets; neither side moves."""
    now = spark.table(dimension).select(key, *[F.col(a).alias(f"__now_{a}") for a in attrs])
    differs = F.lit(False)
    for a in attrs:
        differs = differs | ~F.col(a).eqNullSafe(F.col(f"__now_{a}"))
    return spark.table(fact).join(now.hint("merge"), key).where(differs).drop(*[f"__now_{a}" for a in attrs])
