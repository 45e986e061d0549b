"""A log of batches whose reading stays cheap: tiered runs under a manifest.

A stream writes each micro-batch to ``batch=n``. Compaction joins neighbouring batches into runs whose lengths are powers of two, so n batches are
read from at most log2(n) runs, and each row is rewritten at most log2(n) times. Which runs count is said by the newest manifest, a small
file that appears by one rename: a reader sees the runs of one manifest, before or after, never a mixture. Folders that no
recent manifest names are removed by :func:`vacuum` only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keys import latest_per_key


class _Files:
    """The folder of a log, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def publish(self, text: str, name: str) -> None:
        """Writes beside ``name`` and renames; fails if someone else published ``name``."""
        beside = self.path(f"_manifest/.{uuid.uuid4().hex}")
        out = self.fs.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(beside, self.path(name)):
            self.fs.delete(beside, False)
            raise RuntimeError(f"{name} was published by another compaction")

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _manifests(files: _Files) -> list[str]:
    return [n for n in files.names("_manifest") if not n.startswith(".") and not n.startswith("_")]


def _runs(files: _Files) -> list[dict]:
    """Runs of the newest manifest: first and last batch, folder."""
    found = _manifests(files)
    return json.loads(files.text(f"_manifest/{found[-1]}")) if found else []


def _batches(files: _Files, after: int) -> list[int]:
    numbers = sorted(int(n.split("=")[1]) for n in files.names() if n.startswith("batch="))
    return [n for n in numbers if n > after]


def read(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Contents of a log, its batch numbers dropped: all rows, or the newest row per key."""
    files = _Files(spark, path)
    runs = _runs(files)
    fresh = _batches(files, max((r["last"] for r in runs), default=-1))
    parts = [spark.read.parquet(f"{path}/{r['folder']}") for r in runs]
    if fresh:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in fresh]).withColumn("batch", F.col("batch").cast("long")))
    log = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return (log if keys is None else latest_per_key(log, keys, [F.col("batch").desc()])).drop("batch")


def tiers(runs: Sequence[tuple[int, int, int]], batches: Sequence[int]) -> list[tuple[int, int, int]]:
    """Runs (first, last, tier) after taking in ``batches`` in order: two neighbours of one tier become one of the next."""
    out = list(runs)
    for n in batches:
        out.append((n, n, 0))
        while len(out) > 1 and out[-1][2] == out[-2][2]:
            b, a = out.pop(), out.pop()
            out.append((a[0], b[1], a[2] + 1))
    return out


def compact(spark: SparkSession, path: str, keys: Sequence[str] | None = None) -> int:
    """Takes all batches but the newest (which a restart may write again) into runs; with keys a run keeps the newest row per key. Number of runs."""
    files = _Files(spark, path)
    before = _runs(files)
    batches = _batches(files, max((r["last"] for r in before), default=-1))[:-1]
    if not batches:
        return len(before)
    known = {(r["first"], r["last"]): r for r in before}
    after = []
    for first, last, tier in tiers([(r["first"], r["last"], r["tier"]) for r in before], batches):
        if (first, last) in known:
            after.append(known[first, last])
            continue
        folder = f"runs/{first:010}-{last:010}-{uuid.uuid4().hex[:8]}"
        parts = [spark.read.parquet(f"{path}/{r['folder']}") for r in before if first <= r["first"] and r["last"] <= last]
        own = [f"{path}/batch={n}" for n in batches if first <= n <= last]
        if own:
            parts.append(spark.read.option("basePath", path).parquet(*own).withColumn("batch", F.col("batch").cast("long")))
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        (rows if keys is None else latest_per_key(rows, keys, [F.col("batch").desc()])).write.parquet(f"{path}/{folder}")
        after.append({"first": first, "last": last, "tier": tier, "folder": folder})
    files.publish(json.dumps(after), f"_manifest/{len(_manifests(files)):010}")
    return len(after)


def vacuum(spark: SparkSession, path: str, versions: int = 2) -> None:
    """Removes runs that none of the newest ``versions`` manifests names, and batches that all of them cover. Readers older than these fail."""
    files = _Files(spark, path)
    kept = [json.loads(files.text(f"_manifest/{n}")) for n in _manifests(files)[-versions:]]
    if not kept:
        return
    named = {r["folder"] for m in kept for r in m}
    covered = min(max((r["last"] for r in m), default=-1) for m in kept)
    for n in files.names("runs"):
        if f"runs/{n}" not in named:
            files.fs.delete(files.path(f"runs/{n}"), True)
    for n in files.names():
        if n.startswith("batch=") and int(n.split("=")[1]) <= covered:
            files.fs.delete(files.path(n), True)
