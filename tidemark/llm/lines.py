"""Incremental, reversible line deduplication: an exact table of references, and sharded cuckoo filters in front of it.

The index knows every line key of the documents inserted so far: ``postings`` (key, document), ``refs`` (key, number of documents, largest
document) and, per shard of the key space, cuckoo filters with a fingerprint of each live key. A batch is inserted by counting its
keys and asking the filters of each shard: a key that no filter knows is surely new and is only appended; the others, known keys
and a few false alarms, are merged with the exact table, and the false alarms get a small filter of their own. The table tells which filter holds a
key. Deleting documents takes their references back, and a key without references leaves this filter and no other. A filter is sized for
the keys a batch adds to a shard and never grows; the next batch adds another one. Counting comes first, so a line that a third of all documents share is one row by the time it reaches a shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import WHITE_BYTES, fresh, scratch, smaller_batches

NONE = -(2**63)  # stands for a null id, below all others
SLOTS = 4


class Cuckoo:
    """Cuckoo filter of 16-bit fingerprints in buckets of four; all operations take arrays of 64-bit hashes."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def build(cls, keys: np.ndarray) -> Cuckoo:
        """A filter that holds ``keys`` (repeats count), at most 80 % full."""
        buckets = 1 << max(1, int(np.ceil(len(keys) / (SLOTS * 0.8))) - 1).bit_length()
        while True:
            found = cls(np.zeros((buckets, SLOTS), np.uint16))
            if found._fill(keys):
                return found
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (keys >> np.uint64(48)).astype(np.uint16)
        return np.maximum(mark, 1), (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995 + 0x1B873593 >> 3) & (len(self.table) - 1))

    def _fill(self, keys: np.ndarray, rounds: int = 200) -> bool:
        mark, bucket = self._places(keys)
        draw = np.random.default_rng(1)
        used = np.zeros(len(self.table), np.int64)
        for _ in range(rounds):
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            first = np.append(True, bucket[1:] != bucket[:-1])
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(first, np.arange(len(bucket)), 0))
            slot = used[bucket] + rank
            fits = slot < SLOTS
            self.table[bucket[fits], slot[fits]] = mark[fits]
            np.add.at(used, bucket[fits], 1)
            mark, bucket, rank = mark[~fits], bucket[~fits], slot[~fits] - SLOTS
            if not len(mark):
                return True
            turn = rank == 0  # one newcomer per full bucket throws out an old mark, the others try their other bucket
            at = draw.integers(0, SLOTS, turn.sum())
            thrown = self.table[bucket[turn], at].copy()
            self.table[bucket[turn], at] = mark[turn]
            mark[turn] = thrown
            bucket = self._other(mark, bucket)
        return False

    def has(self, keys: np.ndarray) -> np.ndarray:
        mark, bucket = self._places(keys)
        other = self._other(mark, bucket)
        return (self.table[bucket] == mark[:, None]).any(axis=1) | (self.table[other] == mark[:, None]).any(axis=1)

    def remove(self, keys: np.ndarray) -> np.ndarray:
        """Takes one fingerprint out for each key; True where there was one."""
        mark, bucket = self._places(keys)
        done = np.zeros(len(keys), bool)
        for i, (m, one, two) in enumerate(zip(mark.tolist(), bucket.tolist(), self._other(mark, bucket).tolist(), strict=True)):
            for b in (one, two):
                at = np.flatnonzero(self.table[b] == m)
                if len(at):
                    self.table[b, at[0]] = 0
                    done[i] = True
                    break
        return done


@dataclass
class LineIndex:
    postings: DataFrame  # k1, k2, id
    refs: DataFrame  # k1, k2, n_docs, last, batch (of the filter that holds the key)
    filters: DataFrame  # shard, batch, cells
    shards: int
    batch: int = 0


REFS, FILTERS = "k1 long, k2 long, n_docs long, last long", "shard long, batch int, cells binary"


def empty_index(spark: SparkSession, shards: int) -> LineIndex:
    """An index without documents. ``shards`` should keep a batch's keys per shard below a million or so."""
    return LineIndex(
        spark.createDataFrame([], "k1 long, k2 long, id long"), spark.createDataFrame([], f"{REFS}, batch int"), spark.createDataFrame([], FILTERS), shards
    )


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(WHITE_BYTES).lower()


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _keys(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, digests = [], []
            for i, text in enumerate(b["text"].to_pylist()):
                keys = {k for k in map(line_key, (text or "").encode().split(b"\n")) if _long(k, least)}
                digests += [xxhash.xxh3_128_digest(k) for k in keys]
                rows += [i] * len(keys)
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), b["id"].take(pa.array(rows, pa.int64()))], names=["k1", "k2", "id"]
            )

    return run


def postings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 20) -> DataFrame:
    """``k1, k2, id`` for every row of ``docs`` and each of its distinct keys with ``least`` code points or more (128-bit hashes)."""
    smaller_batches(docs.sparkSession)
    rows = docs.select(_id(doc_id), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_keys(least), "k1 long, k2 long, id long")


def _id(doc_id: str):
    return F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NONE)).alias("id")


def _shard(shards: int):
    return F.pmod(F.col("k2"), F.lit(shards)).alias("shard")


def _ask(key: tuple, batch: pd.DataFrame, filters: pd.DataFrame, number: int) -> pd.DataFrame:
    """Keys of a batch in one shard -> whether a filter may know them; one more row holds the filter of those that none knows."""
    keys = batch["k1"].to_numpy(np.int64).view(np.uint64)
    seen = np.zeros(len(keys), bool)
    for cells in filters["cells"]:
        seen |= Cuckoo(np.frombuffer(cells, np.uint16).reshape(-1, SLOTS)).has(keys)
    out = batch.assign(seen=seen, cells=None)
    if (~seen).any():
        cells = Cuckoo.build(keys[~seen]).table.tobytes()
        out = pd.concat([out, pd.DataFrame([{"shard": key[0], "k1": 0, "k2": 0, "n_docs": 0, "last": number, "seen": False, "cells": cells}])])
    return out


def insert(index: LineIndex, found: DataFrame) -> LineIndex:
    """The index with the :func:`postings` of further documents. No rows change nothing."""
    found, number = scratch(found), index.batch + 1
    late = number + 1  # the filter of false alarms
    counted = found.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("id").alias("last")).select(_shard(index.shards), "*")
    shape = f"shard long, {REFS}, seen boolean, cells binary"
    asked = scratch(
        counted.groupBy("shard").cogroup(index.filters.groupBy("shard"))
        .applyInPandas(lambda key, a, b: _ask(key, a, b, number), shape)
    )
    rows = asked.where("cells is null")
    known = rows.where("seen").select("k1", "k2", F.col("n_docs").alias("more"), F.col("last").alias("later"))
    merged = index.refs.join(known, ["k1", "k2"], "full").select(
        "k1", "k2",
        (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
        F.greatest("last", "later").alias("last"),
        F.coalesce("batch", F.lit(late)).alias("batch"),
    )
    refs = scratch(merged.unionByName(rows.where("not seen").select("k1", "k2", "n_docs", "last", F.lit(number).alias("batch"))))
    fresh = asked.where("cells is not null").select("shard", F.lit(number).alias("batch"), "cells")
    alarms = refs.where(F.col("batch") == late).select(_shard(index.shards), "k1", "batch")
    alarms = scratch(alarms.groupBy("shard").applyInPandas(_hold, FILTERS))
    return LineIndex(index.postings.unionByName(found), refs, index.filters.unionByName(fresh).unionByName(alarms), index.shards, late)


def _hold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    cells = Cuckoo.build(rows["k1"].to_numpy(np.int64).view(np.uint64)).table.tobytes()
    return pd.DataFrame([{"shard": key[0], "batch": rows["batch"].iloc[0], "cells": cells}])


def _forget(key: tuple, dead: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    keys = {batch: k.to_numpy(np.int64).view(np.uint64) for batch, k in dead.groupby("batch")["k1"]}
    cells = []
    for batch, c in zip(filters["batch"], filters["cells"], strict=True):
        one = Cuckoo(np.frombuffer(c, np.uint16).reshape(-1, SLOTS).copy())
        if batch in keys:
            one.remove(keys[batch])
        cells.append(one.table.tobytes())
    return filters.assign(cells=cells)


def delete(index: LineIndex, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
    """The index as if the documents with these ids had never been inserted; unknown ids change nothing.

    A key that stays gets its count and largest document anew from the exact postings; one that goes leaves the filter that holds it too (which
    may give up the equal fingerprint of another key of the same two buckets, which is then the one that stays).
    """
    gone = ids.select(_id(doc_id)).distinct()
    left = scratch(index.postings.join(gone, "id", "left_anti").select("k1", "k2", "id"))
    touched = scratch(index.postings.join(gone, "id", "left_semi").select("k1", "k2").distinct())
    again = left.join(touched, ["k1", "k2"]).groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("id").alias("last"))
    held = index.refs.select("k1", "k2", "batch").join(touched, ["k1", "k2"])
    again = scratch(held.join(again, ["k1", "k2"], "left").select("k1", "k2", "n_docs", "last", "batch"))
    stay = again.where("n_docs is not null")
    refs = scratch(index.refs.join(touched, ["k1", "k2"], "left_anti").unionByName(stay))
    dead = again.where("n_docs is null").select(_shard(index.shards), "k1", "batch")
    filters = scratch(dead.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInPandas(_forget, FILTERS))
    return LineIndex(left, refs, filters, index.shards, index.batch)


def _apply(least: int, text: str, marks: str, counts: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, lines, dropped = [], [], []
            lost = b[marks]
            pairs = np.stack([lost.flatten().field(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2")], axis=1).astype(np.int64).tobytes()
            ends = np.append(0, np.cumsum([n or 0 for n in lost.value_lengths().to_pylist()])) * 16
            for i, whole in enumerate(b[text].to_pylist()):
                drop = {pairs[j : j + 16] for j in range(ends[i], ends[i + 1], 16)}
                parts = (whole or "").encode().split(b"\n")
                lines.append(len(parts))
                if drop:
                    stay = [p for p in parts if xxhash.xxh3_128_digest(k := line_key(p)) not in drop or not _long(k, least)]
                    kept.append(b"\n".join(stay).decode() if stay else "")
                    dropped.append(len(parts) - len(stay))
                else:
                    kept.append(whole)
                    dropped.append(0)
            names = [n for n in b.schema.names if n != marks]
            new = [pa.array(kept, pa.string()) if n == text else b[n] for n in names]
            yield pa.RecordBatch.from_arrays([*new, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *counts])

    return run


def clean(
    docs: DataFrame, found: DataFrame, index: LineIndex, doc_id: str = "doc_id", text: str = "text", least: int = 20, at_least: int = 3,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` without the lines whose key ``at_least`` documents of the index hold, except in the largest of these; ``counts`` are added.

    ``found`` are the postings of ``docs``. All lines with such a key go, or all stay (largest document). Each row counts as a document,
    also one with a repeated id; rows of one id are treated alike. A null id is below all others. A null or empty text is one
    empty line, and a text that loses no line stays as it is, null too; one that loses all is empty. Other columns stay, but for any named
    like ``counts``; no rows give no rows.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {x.lower() for x in counts}])
    often = index.refs.where(F.col("n_docs") >= at_least).select("k1", "k2", "last")
    lost = found.join(often, ["k1", "k2"]).where("id < last").select("id", F.struct("k1", "k2").alias("key"))
    own, marks = fresh(docs, "_lost"), fresh(docs, "_marks")
    lost = scratch(lost.groupBy(F.col("id").alias(own)).agg(F.collect_set("key").alias(marks)))
    joined = docs.join(lost, F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NONE)) == F.col(own), "left").drop(own)
    shape = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in counts]])
    return joined.mapInArrow(_apply(least, text, marks, counts), shape)


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 20, at_least: int = 3, batches: int = 2, keys_per_shard: int = 500_000,
    counts: tuple[str, str] = ("n_lines", "n_dropped"), withdrawn: DataFrame | None = None,
) -> DataFrame:
    """:func:`clean` for a whole table, inserted into a new index in ``batches`` by a hash of the id, as deliveries would be.

    ``withdrawn`` are documents with ids of their own that were delivered first and are deleted again after the first batch: the result is as if they
    had never been there.
    """
    found = scratch(postings(docs, doc_id, text, least))
    index = empty_index(docs.sparkSession, max(1, -(-found.count() // keys_per_shard)))
    if withdrawn is not None:
        index = insert(index, postings(withdrawn, doc_id, text, least))
    for i in range(batches):
        index = insert(index, found.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i))
        if i == 0 and withdrawn is not None:
            index = delete(index, withdrawn, doc_id)
    return clean(docs, found, index, doc_id, text, least, at_least, counts)
