"""Groups that arrive sorted in Python workers, and connected components in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows_at_once: int = 8192) -> Iterator[pa.Table]:
    """Batches sorted by the int64 column ``key`` -> tables of complete groups, of about ``rows_at_once`` rows or one large group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += len(b)
        if rows < rows_at_once:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table[key].to_numpy()
        if keys[0] != keys[-1]:  # all but the last group are complete
            done = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
            yield table.slice(0, done)
            held, rows = table.slice(done).to_batches(), len(table) - done
        else:
            held = table.to_batches()
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index connected with each of ``n`` indices, given edges between ``a`` and ``b``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return root


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Edges ``a, b`` (long, not null) -> ``node, root``: the least node of its component, for all nodes of edges except the roots.

    Alternates large and small stars, which halves the distance to the root each time; a round is two joins on the nodes, and a node with
    many edges is met by an aggregation and a join that Spark can split.
    """
    e = scratch(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = scratch(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(low, "a")
        small = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        e = scratch(small.distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
    raise RuntimeError(f"components are still growing after {rounds} rounds")
