"""Registry of named queries: the Spark plan and, where SQL can say it, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the input tables: ``t.orders`` is a scan, pruned and filtered by Catalyst."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, covers: str = ""):
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(covers.split()))
        return fn

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY[name].build(Tables(spark, folder))
