"""Target-distribution importance resampling: documents drawn by how much likelier their words are in a target than in the corpus.

Every run of words falls into a bucket; a bucket's gain is the log of its share in the target over its share in the corpus, and a text's weight is
the sum of gains over its runs, looked up as one array. Noise that depends on the id alone turns the weights into a draw without replacement
in the order of scores.

The draw needs exact ranks of all scores, by parallel sorting by regular sampling: each partition is sorted as a run and gives regular samples; the
sorted samples give regular splitters; a run is cut at the splitters, segments are exchanged and each sorted where it arrives, and the counts of
the segments before it turn places into ranks. Segments behind the last rank drawn aren't exchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, smaller_batches

#: Bytes of words: digits, letters (A-Z lowered) and all above 0x7F; the rest parts words.
WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256))


class Buckets(dict):
    """crc32 of a feature modulo the number of buckets; remembers up to ``most`` of them."""

    def __init__(self, buckets: int, most: int = 500_000):
        self.buckets, self.most = buckets, most

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found

    def of(self, text: str | None, longest: int) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every run of them."""
        words = (text or "").encode().translate(WORDS).split()
        runs = words if longest == 1 else [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), np.fromiter(map(self.__getitem__, runs), np.uint32, len(runs))


def _features(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(buckets)
        narrow = np.uint16 if buckets <= 1 << 16 else np.uint32
        for b in batches:
            n_words, found = zip(*[known.of(t, longest) for t in b["text"].to_pylist()], strict=True) if len(b) else ((), ())
            rest = [c for c in b.schema.names if c != "text"]
            new = [
                pa.array(n_words, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array([x.astype(narrow).tobytes() for x in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in rest], *new], names=[*rest, "n_words", "n_features", "features"])

    return run


def _array(cell: bytes, buckets: int) -> np.ndarray:
    return np.frombuffer(cell, np.uint16 if buckets <= 1 << 16 else np.uint32)


def _sums(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for b in batches:
            cells = b["features"].to_pylist()
            if cells:
                sums += np.bincount(_array(b"".join(cells), buckets), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    return run


def described(docs: DataFrame, buckets: int, longest: int, text: str, *keep: str) -> DataFrame:
    """Per row the columns ``keep``, ``n_words``, ``n_features`` and ``features``, the buckets of all its runs of words."""
    smaller_batches(docs.sparkSession)
    kinds = dict(docs.dtypes)
    shape = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_words long, n_features long, features binary"])
    return scratch(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("text")).mapInArrow(_features(buckets, longest), shape))


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences by bucket over all rows, one number per bucket."""
    out = np.zeros(buckets, np.int64)
    for r in features.select("features").mapInArrow(_sums(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of a nat by bucket, rounded down."""
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype(np.int64)


def _weights(sent, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for b in batches:
            weight = [int(gain[_array(x, buckets)].sum()) for x in b["features"].to_pylist()]
            rest = [c for c in b.schema.names if c != "features"]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in rest], pa.array(weight, pa.int64())], names=[*rest, "weight"])

    return run


def _keys(score: np.ndarray, key: np.ndarray) -> np.ndarray:
    """(score, key) as one array that sorts best first."""
    out = np.empty(len(score), [("score", "<i8"), ("key", "<i8")])
    out["score"], out["key"] = -score, key
    return out


def _cut(sent):
    """Segment of each row of a run: how many splitters come before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = _keys(*sent.value)
        for b in batches:
            segment = np.searchsorted(splitters, _keys(b["score"].to_numpy(), b["key"].to_numpy())).astype(np.int32)
            yield b.append_column("segment", pa.array(segment))

    return run


def ranked(scored: DataFrame, most: int, order: list, segments: int | None = None, samples: int = 1_000_000) -> DataFrame:
    """Adds ``rank`` (1, 2, ... by ``score``, best first, then ``key``, both long, then ``order``) to the first ``most`` of all rows, null behind.

    A row's run is its partition. All runs give up to ``samples`` regular samples together, at least 16 each, from which the splitters are taken on
    the driver; so a segment can't exceed its share of the rows by more than a sample's distance from each run.
    """
    spark = scored.sparkSession
    by = [F.col("score").desc(), F.col("key"), *order]
    runs = scratch(scored.sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    lengths = runs.groupBy(F.shiftright("at", 33).alias("run")).agg(F.count("*").alias("length"))
    found = lengths.agg(F.count("*").alias("runs"), F.sum("length").alias("rows")).first()
    segments = segments or max(int(spark.conf.get("spark.sql.shuffle.partitions")), (found.rows or 0) // 500_000)
    each = max(16, min(segments, samples // max(1, found.runs)))
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    every = F.greatest(F.floor(F.col("length") / each), F.lit(1))
    told = runs.select("score", "key", "at", F.shiftright("at", 33).alias("run")).join(lengths, "run").where(place % every == every - 1)
    table = told.select("score", "key").toArrow()
    score, key = table["score"].to_numpy(), table["key"].to_numpy()
    sort = np.lexsort((key, -score))
    picked = sort[(np.arange(1, segments) * len(sort) // segments)] if len(sort) else sort
    sent = spark.sparkContext.broadcast((score[picked], key[picked]))
    shape = ", ".join(f"`{n}` {t}" for n, t in [*scored.dtypes, ("segment", "int")])
    cut = scratch(runs.drop("at").mapInArrow(_cut(sent), shape))
    counts = cut.groupBy("segment").agg(F.count("*").alias("n")).collect()  # one row per segment
    before, carried = 0, {}
    for r in sorted(counts, key=lambda r: r.segment):
        if before < most:
            carried[r.segment] = before
        before += r.n
    if not carried:
        return cut.drop("segment").withColumn("rank", F.lit(None).cast("long"))
    last = max(carried)
    starts = spark.createDataFrame(list(carried.items()), "segment int, before long")
    place = F.row_number().over(W.partitionBy("segment").orderBy(*by))
    near = cut.where(F.col("segment") <= last).withColumn("place", place).join(F.broadcast(starts), "segment")
    rank = F.col("before") + F.col("place")
    near = near.withColumn("rank", F.when(rank <= most, rank)).select(*scored.columns, "rank")
    return near.unionByName(cut.where(F.col("segment") > last).drop("segment").withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = 10_000, longest: int = 1, percent: int = 10, least: int = 20, seed: str = "2024",
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row of ``docs``; ``rank`` is null for those not drawn.

    Features are all runs of 1 to ``longest`` words. Drawn are ``percent`` percent, rounded down, of the rows with at least ``least`` words. Null and
    empty texts have no features and weight 0. A null id counts as empty in the noise and comes last among equal scores; rows of equal id and score are
    ordered by weight and number of features. An empty target makes all gains alike but for counts; no rows give no rows. Other columns aren't read.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    told = described(docs, buckets, longest, "text", "doc_id")
    wanted = described(target, buckets, longest, target_text)
    gain = gains(bucket_counts(told, buckets), bucket_counts(wanted, buckets))
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    weighed = told.mapInArrow(_weights(sent, buckets), "doc_id long, n_words long, n_features long, weight long")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    chance = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(chance)))
    scored = scratch(weighed.withColumn("score", F.col("weight") + noise).withColumn("key", F.coalesce("doc_id", F.lit(2**63 - 1))))
    able = F.col("n_words") >= least
    order = [F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features")]
    drawn = ranked(scored.where(able), scored.where(able).count() * percent // 100, order)
    out = drawn.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, whole. Ids must be unique for this."""
    found = resample(docs, target, doc_id=doc_id, **options).where("rank is not null").select(F.col("doc_id").alias(doc_id))
    return docs.join(found, doc_id, "left_semi")
