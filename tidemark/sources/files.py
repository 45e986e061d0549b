"""Reading and writing files: typed views of raw landing data, exports and the CSV jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_source(raw: DataFrame, columns: Mapping[str, tuple[str, str]], deleted: str | None = None, strict: bool = True) -> DataFrame:
    """Rename and cast layer over a raw table: ``new name -> (old name, type)``; rows flagged deleted are dropped."""
    df = raw.where(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else raw
    return df.select(*[(F.col(o).cast(k) if strict else F.col(o).try_cast(k)).alias(n) for n, (o, k) in columns.items()])


def read_sheet(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Uploaded CSV: every field read as text, empty text is NULL, then cast where it parses."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, header=True, schema=schema, escape='"')
    return raw.select(*[F.nullif(F.trim(c), F.lit("")).try_cast(k).alias(c) for c, k in columns.items()])


def read_json_partitions(spark: SparkSession, path: str, schema: str, partition: str, since: str | None = None) -> DataFrame:
    """JSON files under hive-style partition folders; a bound on the partition column prunes folders."""
    df = spark.read.schema(f"{schema}, {partition} DATE").json(path)
    return df.where(F.col(partition) >= F.lit(since).cast("date")) if since else df


def explode_feed(df: DataFrame, json: str, element: str) -> DataFrame:
    """List of objects held as one JSON text to one row per object."""
    return df.select(*[x for x in df.columns if x != json], F.explode(F.from_json(json, f"ARRAY<STRUCT<{element}>>")).alias("__e")).select(
        *[x for x in df.columns if x != json], "__e.*")


def search_files(spark: SparkSession, path: str, pattern: str, glob: str = "*") -> DataFrame:
    """Lines of the files under a folder that match a pattern, with path and 1-based line number."""
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True, recursiveFileLookup=True)
    lines = files.where(F.col("value").rlike(pattern)).select(F.input_file_name().alias("path"), F.posexplode(F.split("value", "\n")).alias("__p", "line"))
    return lines.where(F.col("line").rlike(pattern)).select("path", (F.col("__p") + 1).alias("line_number"), "line")


def changed_rows(df: DataFrame, changed: str, run_date: dt.date, valid: Column) -> DataFrame:
    """Export feed: valid rows that changed on the run date."""
    return df.where(valid & (F.col(changed) == F.lit(run_date)))


def write_feed(df: DataFrame, path: str, run_date: dt.date, fmt: str = "json") -> None:
    df.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").format(fmt).save(path)


def mail_list(df: DataFrame, key: str, order: str, columns: Sequence[str], keep: Column) -> DataFrame:
    """One row per address for a mailing, in a CSV shape."""
    return df.where(keep).groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(order, *columns)).alias("r")).select(key, "r.*")


def share_view(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Outbound share: only the columns on the allow-list."""
    return df.select(*allowed)


def csv_update(spark: SparkSession, src: str, dst: str, columns: Mapping[str, str], key: str, col: str, change) -> None:
    """Rewrite a CSV with one column changed, all rows kept and in key order.

    The output is range-partitioned by the key, so the part files read in name order give the rows in order without
    one task writing the whole file.
    """
    schema = ", ".join(f"{c} {k}" for c, k in columns.items())
    df = spark.read.csv(src, header=True, schema=schema, mode="FAILFAST")
    out = df.withColumn(col, change(F.col(col)).cast(columns[col]))
    out.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").csv(dst, header=True)


def sampled_diff(a: DataFrame, b: DataFrame, key: str, col: str, expected, every: int, tolerance: float) -> DataFrame:
    """Compare evenly spaced rows (by key) of two tables: checked, differing and missing rows, and the row counts."""
    x = a.where((F.col(key) - 1) % every == 0).select(key, expected(F.col(col)).alias("__want"))
    y = b.select(key, F.col(col).alias("__got"))
    j = x.join(y, key, "left")
    off = F.abs(F.col("__got") - F.col("__want")) > tolerance
    stats = j.agg(F.count("*").alias("checked"), F.count_if(off).alias("differing"), F.count_if(F.col("__got").isNull()).alias("missing"))
    return stats.select("*", a.agg(F.count("*")).scalar().alias("rows_before"), b.agg(F.count("*")).scalar().alias("rows_after"))
