"""Sharding by longest processing time: groups that must stay together go, largest first, to the least-loaded shard of a heap.

Groups of equal size are alike to the rule, so it runs over distinct sizes and the number of groups of each: where a size has many groups, one
search finds how many each shard takes. Distinct sizes are at most twice the square root of all sizes together, whatever the number of groups,
and pass through the heap one after the other, so the one task that holds the heap keeps a load per shard and nothing else.
Which groups of a size go to which shard follows from their order by first id, and a row's slot from the order of ids
within its shard. Both positions come from :func:`placed`, which cuts a large size or shard by volume.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, scratch


def placed(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``, the 0-based position of a row among those of ``key`` (not null) in ``order``. Columns starting with ``_at`` are taken.

    Rows are dealt to partitions by sampled ranges of (key, order), so a key may lie in many; each partition is sorted and its rows numbered,
    and one row per key and partition carries the count of those before.
    """
    rows = scratch(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_at_part", F.shiftright("_at", 33))
    pieces = rows.groupBy(key, "_at_part").agg(F.min("_at").alias("_at_first"), F.count("*").alias("_at_n"))
    before = F.sum("_at_n").over(W.partitionBy(key).orderBy("_at_part").rowsBetween(W.unboundedPreceding, -1))
    pieces = pieces.withColumn("_at_before", F.coalesce(before, F.lit(0)))
    told = rows.join(pieces, [key, "_at_part"])
    return told.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_at") - F.col("_at_first") + F.col("_at_before")).alias(name))


class Shards:
    """Loads of the shards in a heap; equal loads go by shard number."""

    def __init__(self, shards: int):
        self.heap = [(0, k) for k in range(shards)]

    def _one(self, size: int) -> int:
        load, k = self.heap[0]
        heapq.heapreplace(self.heap, (load + size, k))
        return k

    def take(self, size: int, n: int) -> list[int]:
        """How many of ``n`` groups of ``size`` each shard takes when each goes to the least-loaded one."""
        counts = [0] * len(self.heap)
        if size > 0 and n > 4 * len(counts):
            # below a level, every shard takes all that start there; the highest level that n groups reach, then the rest by the heap
            low = self.heap[0][0]
            high = low + size * n
            while low < high:
                level = (low + high + 1) // 2
                if sum(-(-(level - load) // size) for load, _ in self.heap if load < level) <= n:
                    low = level
                else:
                    high = level - 1
            for load, k in self.heap:
                counts[k] = max(0, -(-(low - load) // size))
            self.heap = [(load + size * counts[k], k) for load, k in self.heap]
            heapq.heapify(self.heap)
        for _ in range(n - sum(counts)):
            counts[self._one(size)] += 1
        return counts


def _deal(shards: int):
    """Sizes, largest first, with their number of groups -> per size, where each shard's share of its groups ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = Shards(shards)
        for b in batches:
            ends = [np.cumsum(heap.take(s, n)).tolist() for s, n in zip(b["size"].to_pylist(), b["n"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["size"], pa.array(ends, pa.list_(pa.int64()))], names=["size", "ends"])

    return run


def least_loaded(groups: DataFrame, shards: int) -> DataFrame:
    """``group, first, size`` (one row per group, size at least 0) -> ``group, shard``.

    Groups of equal size are dealt in the order of ``first`` and ``group``: the earliest to the lowest shard number of those that take one.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    sizes = groups.groupBy("size").agg(F.count("*").alias("n"))
    ends = scratch(sizes.repartition(1).sortWithinPartitions(F.col("size").desc()).mapInArrow(_deal(shards), "size long, ends array<long>"))
    ranked = placed(groups, "size", ["first", "group"], "rank")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("rank")))
    return ranked.join(ends, "size").select("group", shard.alias("shard"))


def shard(
    docs: DataFrame,
    size: Column | None = None,
    group: Column | None = None,
    shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    names: tuple[str, str] = ("shard", "slot"),
) -> DataFrame:
    """The columns of ``docs`` and ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 in each shard, without gaps, by id).

    ``group`` tells what must stay together, by default equal texts; ``size`` is a row's weight, by default the UTF-8 bytes of the text plus 8. A
    null text is as an empty one, a null group is a group of its own, a null size 0. Null ids come first and rows of equal ids are ordered by
    group; equal rows may swap their slots. Columns that have the names of the new ones keep theirs; the new ones get ``_`` appended.
    No rows give no rows. The same rows get the same places in any layout.
    """
    own = F.col(f"`{text}`") if text in docs.columns else F.lit(None).cast("string")
    size = F.coalesce((F.octet_length(F.coalesce(own, F.lit(""))) + 8 if size is None else size).cast("long"), F.lit(0).cast("long"))
    group = F.md5(F.coalesce(own, F.lit("")).cast("binary")) if group is None else F.coalesce(group.cast("string"), F.lit("\x00"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{doc_id}`").alias("id"), size.alias("size"), group.alias("group"),
    )
    # read twice rather than written out: once for the groups, once for the rows
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.min("id").alias("first"))
    dealt = least_loaded(scratch(groups), shards)
    at = placed(rows.drop("size").join(dealt, "group").withColumn("tie", F.monotonically_increasing_id()), "shard", ["id", "group", "tie"], "slot")
    return at.select("doc.*", F.col("shard").cast("int").alias(fresh(docs, names[0])), F.col("slot").alias(fresh(docs, names[1])))


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """The sharded rows as Parquet, one folder ``shard=k`` for each, its files in the order of slots."""
    out = shard(docs, **options)
    where, slot = out.columns[-2:]
    out.repartitionByRange(where, slot).sortWithinPartitions(where, slot).write.partitionBy(where).parquet(folder)
