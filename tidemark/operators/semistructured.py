"""JSON contexts, nested payloads, lists and key-value text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

CONTEXTS = "STRUCT<data: ARRAY<STRUCT<schema: STRING, data: STRING>>>"


def unpack_context(df: DataFrame, json: str, schema_like: str, fields: Mapping[str, str], prefix: str = "") -> DataFrame:
    """Typed fields of the first context whose schema matches a LIKE pattern; NULLs when there is none.

    Values may come as JSON numbers, booleans or strings: they are read as text and cast where they parse.
    """
    element = F.get(F.filter(F.from_json(json, CONTEXTS)["data"], lambda x: x["schema"].like(schema_like)), F.lit(0))
    out = df.withColumn("__ctx", F.from_json(element["data"], "MAP<STRING, STRING>"))
    return out.select(*df.columns, *[F.col("__ctx")[k].try_cast(kind).alias(f"{prefix}{k}") for k, kind in fields.items()])


def unpack_event(df: DataFrame, name: str, names: Sequence[str], json: str, fields: Mapping[str, str], prefix: str) -> DataFrame:
    """Fields of an event's JSON body, for the listed event names only."""
    body = F.from_json(F.when(F.col(name).isin(*names), F.col(json)), "MAP<STRING, STRING>")
    out = df.withColumn("__body", body)
    return out.select(*df.columns, *[F.col("__body")[k].try_cast(kind).alias(f"{prefix}{k}") for k, kind in fields.items()])


def flatten_metrics(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Leaves of a nested JSON payload as (path, value); -1 stands for a timed-out count and becomes 0 with a flag.

    One generator per level, until no level is left; the nested part of a level is written once before the next.
    """
    spark = df.sparkSession
    level = df.select(key, F.try_parse_json(payload).alias("__v"), F.lit("").alias("__path"))
    leaves = []
    while True:
        parts = level.lateralJoin(spark.tvf.variant_explode(F.col("__v").outer())).select(
            F.col(key), F.col("value").alias("__v"),
            F.when(F.col("key").isNotNull(), F.concat(F.col("__path"), F.when(F.col("__path") == "", "").otherwise("."), F.col("key")))
            .otherwise(F.concat(F.col("__path"), F.lit("["), F.col("pos").cast("string"), F.lit("]"))).alias("__path"))
        nested = F.schema_of_variant("__v").rlike("^(OBJECT|ARRAY)")
        parts = cut_lineage(parts)
        leaves.append(parts.where(~nested))
        level = parts.where(nested)
        if level.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, leaves)
    text = F.try_variant_get("__v", "$", "string")
    late = F.coalesce(text == "-1", F.lit(False))
    return rows.select(key, F.col("__path").alias("path"), F.when(late, "0").otherwise(text).alias("value"), late.alias("has_timed_out"))


def explode_list(df: DataFrame, arr: Column, name: str, outer: bool = False) -> DataFrame:
    """One row per list element; ``outer`` keeps rows whose list is empty or missing."""
    return df.select("*", (F.explode_outer if outer else F.explode)(arr).alias(name))


def split_rows(df: DataFrame, text: str, sep_pattern: str) -> DataFrame:
    """One row per piece of a text with its 1-based index."""
    return df.select("*", F.posexplode(F.split(text, sep_pattern)).alias("__p", "piece")).withColumn("index", F.col("__p") + 1).drop("__p")


def parse_kv_blob(df: DataFrame, key: Sequence[str], text: str, fields: Mapping[str, str], deferred: Sequence[str] = ()) -> DataFrame:
    """``key: value`` lines to columns. The value of a ``deferred`` timestamp key that does not parse on its own line
    is taken from the third or fourth line after it.

    A text is taken apart and put into columns inside its row, so nothing is exploded or shuffled.
    """
    def value_at(line: Column) -> Column:
        at = F.locate(": ", line)
        return F.nullif(F.btrim(F.when(at > 0, F.substr(line, at + 2)), F.lit("'")), F.lit(""))

    lines = df.select(*key, F.split(text, "\n").alias("__lines"))
    entries = lines.select(*key, "__lines", F.transform(
        "__lines", lambda line, pos: F.struct(F.trim(F.split_part(line, F.lit(": "), F.lit(1))).alias("key"), pos.alias("pos"), line.alias("line"))).alias("__entries"))

    def field(name: str, kind: str) -> Column:
        def read(e: Column) -> Column:
            got = value_at(e["line"]).try_cast(kind)
            if name in deferred:
                later = [value_at(F.get("__lines", e["pos"] + n)).try_cast(kind) for n in (3, 4)]
                got = F.coalesce(got, *later)
            return got

        return F.array_max(F.transform(F.filter("__entries", lambda e: e["key"] == name), read))

    return entries.select(*key, *[field(n, k).alias(n) for n, k in fields.items()])


def object_array_to_map(x: Column) -> Column:
    """``[{key, value: {string_value | int_value | ...}}]`` as a map of text."""
    kind = "ARRAY<STRUCT<key: STRING, value: MAP<STRING, STRING>>>"
    entries = F.transform(F.from_json(x, kind), lambda e: F.struct(
        e["key"].alias("key"), F.get(F.filter(F.map_values(e["value"]), lambda v: v.isNotNull()), F.lit(0)).alias("value")))
    return F.map_from_entries(entries)


def object_insert(m: Column, key: str, value: Column) -> Column:
    return F.map_concat(object_delete(m, key), F.create_map(F.lit(key), value))


def object_delete(m: Column, key: str) -> Column:
    return F.map_filter(m, lambda k, v: k != key)


def merge_duplicate_payloads(df: DataFrame, payload: Sequence[str], arrays: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Fold rows that are equal once nested arrays are sorted; measures are multiplied by the number of copies."""
    canon = df.withColumns({a: F.array_sort(a) for a in arrays})
    folded = canon.groupBy(*payload, *arrays, *measures).agg(F.count("*").alias("occurrence_multiplier"))
    return folded.withColumns({m: F.col(m) * F.col("occurrence_multiplier") for m in measures})
