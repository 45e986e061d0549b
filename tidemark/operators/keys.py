"""Identity, de-duplication and change capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import salted_hash


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The n first rows per key under a total order.

    The rank filter lets Spark keep only n rows per key in every map task before the shuffle, so a key that holds a
    third of the table still sends only n rows per task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def distinct_source(df: DataFrame, cols: Sequence[str], loaded_at: str) -> DataFrame:
    """Distinct business rows with the first and last time they were loaded."""
    return df.groupBy(*cols).agg(F.min(loaded_at).alias("valid_from"), F.max(loaded_at).alias("last_loaded_at"))


def propagate_dimension_changes(fact: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Fact rows whose stored copy of a dimension attribute no longer agrees with the dimension."""
    now = dim.select(key, *[F.col(a).alias(f"__now_{a}") for a in attrs])
    stale = F.lit(False)
    for a in attrs:
        stale = stale | ~F.col(a).eqNullSafe(F.col(f"__now_{a}"))
    return fact.join(now, key).where(stale).select(*fact.columns)


def hash_pii(df: DataFrame, cols: Sequence[str], salt: str, keep: Sequence[str] = ()) -> DataFrame:
    """Replace personal columns by salted hashes ``<col>_hash``; columns in ``keep`` stay beside their hash."""
    out = [F.col(x) for x in df.columns if x not in cols or x in keep]
    return df.select(*out, *[salted_hash(x, salt).alias(f"{x}_hash") for x in cols])


def row_hash(cols: Sequence[str]) -> Column:
    """Hash of the columns' texts, each behind its length, so that neither separators nor NULL can be mistaken for a value."""
    text = [F.col(x).cast("string") for x in cols]
    return F.md5(F.concat(F.lit(""), *[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text]))


def hash_diff(now: DataFrame, prev: DataFrame, key: str, cols: Sequence[str], as_of) -> DataFrame:
    """Compare tracked columns with the previous build: status and the date of the last change.

    ``prev`` carries ``last_changed`` of the earlier build.
    """
    a = now.select(key, row_hash(cols).alias("__now"))
    b = prev.select(key, row_hash(cols).alias("__was"), F.col("last_changed").alias("__since"))
    status = (
        F.when(F.col("__was").isNull(), "inserted")
        .when(F.col("__now").isNull(), "deleted")
        .when(F.col("__now") != F.col("__was"), "changed")
        .otherwise("unchanged")
    )
    return a.join(b, key, "full").select(
        key, status.alias("status"),
        F.when(status == "unchanged", F.col("__since")).otherwise(F.lit(as_of)).alias("last_changed"),
    )


def with_audit(df: DataFrame, created_by: str, updated_by: str, created_date: str, updated_date: str) -> DataFrame:
    """Author and build-time columns of a written table (kept out of comparisons)."""
    return df.withColumns({
        "created_by": F.lit(created_by), "updated_by": F.lit(updated_by),
        "model_created_date": F.lit(created_date).cast("date"), "model_updated_date": F.lit(updated_date).cast("date"),
        "built_at": F.current_timestamp(),
    })


def with_missing_member(dim: DataFrame, defaults: dict) -> DataFrame:
    """Dimension plus one row that facts without a match can point to."""
    row = dim.sparkSession.range(1).select(
        *[F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)


def single_field_dimension(df: DataFrame, col: str, id_name: str, name: str) -> DataFrame:
    """Distinct non-null values of one column with a key, plus the missing member."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias(name)).distinct()
    dim = values.select(F.md5(name).alias(id_name), name)
    missing = df.sparkSession.range(1).select(F.md5(F.lit("-1")).alias(id_name), F.lit(f"Missing {name}").alias(name))
    return dim.unionByName(missing)
