"""The corpus pipeline: each stage works on all that the one before kept, written as Parquet and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, lines, mixing, quality
from tidemark.llm.common import fresh, scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of 0.7 or more), whole."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that three or more hold, except in the largest of these; ``n_chars`` follows the text."""
    counts = (fresh(docs, "_n_lines"), fresh(docs, "_n_dropped"))
    cleaned = lines.dedup_lines(docs, counts=counts).drop(*counts)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id."""
    return jaccard.keep_first(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a row for each copy, numbered in ``copy``."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", not_in_benchmark),
    ("mixing sources", mixed),
]

#: The classifier can't be said in SQL; tests compare the other stages with brute force on what each received.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
