"""Quality classifier: boosted trees over statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm import boosting
from tidemark.llm.common import crc, fresh, scratch, smaller_batches

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_length", "word_length_spread", "longest_word", "short_words", "distinct_words",
    "commonest_word", "doubled_words", "distinct_pairs", "distinct_lines", "line_length", "ended_lines", "capitals", "capital_words",
    "digits", "symbols", "bars", "exclamations", "stops", "commas", "other_marks", "beyond_ascii", "byte_entropy",
)


def statistics(text: str | None) -> list[float]:
    """FEATURES of one whole text; shares of an empty text are 0."""
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words, lines = data.split(), data.split(b"\n")
    n, n_words, n_lines = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    often = Counter(words)
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    of = lambda chars: int(counts[list(chars)].sum())
    p = counts[counts > 0] / n
    return [
        float(np.log1p(len(data))), float(np.log1p(len(words))), float(np.log1p(len(lines))),
        float(sizes.mean()), float(sizes.std()), float(sizes.max()), float((sizes <= 3).sum() / n_words),
        len(often) / n_words, max(often.values(), default=0) / n_words,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n_words, len(set(zip(words, words[1:], strict=False))) / n_words,
        len(set(lines)) / n_lines, len(data) / n_lines, sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / n_lines,
        int(counts[65:91].sum()) / letters, sum(w.isupper() for w in often) / max(1, len(often)),
        int(counts[48:58].sum()) / n, of(b"#*$%&<>") / n_words, of(b"|") / n_words, of(b"!") / n_words,
        of(b".") / n_words, of(b",") / n_words, (marks - of(b"#*$%&<>|!.,")) / n_words, int(counts[128:].sum()) / n,
        float(-(p * np.log2(p)).sum()) if len(data) else 0.0,
    ]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rest = [n for n in b.schema.names if n != "text"]
        found = pa.array([statistics(x) for x in b["text"].to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*[b[n] for n in rest], found], names=[*rest, "features"])


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, features`` per row of ``docs``, written once."""
    smaller_batches(docs.sparkSession)
    kind = docs.select(F.col(f"`{doc_id}`")).dtypes[0][1]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return scratch(rows.mapInArrow(_features, f"doc_id {kind}, features array<double>"))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b["features"].flatten().to_numpy().reshape(-1, len(FEATURES))


def _train(options: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [np.zeros((0, len(FEATURES)))], [np.zeros(0)]
        for b in batches:
            x.append(_matrix(b))
            y.append(b["label"].to_numpy().astype(float))
        model = boosting.train(np.concatenate(x), np.concatenate(y), **options).pack()
        yield pa.RecordBatch.from_pylist([model], schema=pa.schema([
            ("base", pa.float64()), ("feature", pa.list_(pa.list_(pa.int64()))),
            ("threshold", pa.list_(pa.list_(pa.float64()))), ("leaf", pa.list_(pa.list_(pa.float64()))),
        ]))

    return run


def fit(features: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", doc_id: str = "doc_id", sample: int = 100_000, **options) -> boosting.Trees:
    """Trees from the rows of ``features`` that have a label and for which ``learn`` (a condition on ``doc_id``) holds.

    At most about ``sample`` labelled rows take part, chosen by a hash of the id, as one task trains; null labels and ids are left out, a repeated
    label counts each time. Without both labels the model is the smoothed share of label 1.
    """
    told = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("label")).where("_id is not null and label is not null")
    rows = scratch(features.where(learn).join(told, F.col("doc_id") == F.col("_id")).select("doc_id", "label", "features"))
    share = min(1.0, sample / max(1, rows.count()))
    taken = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000))
    model = taken.repartition(1).sortWithinPartitions("doc_id", "label").select("features", "label").mapInArrow(
        _train(options), "base double, feature array<array<bigint>>, threshold array<array<double>>, leaf array<array<double>>"
    ).collect()
    return boosting.Trees.unpack(model[0].asDict() if model else boosting.train(np.zeros((0, len(FEATURES))), np.zeros(0)).pack())


def score(features: DataFrame, model: boosting.Trees) -> DataFrame:
    """``doc_id, score``: the chance of label 1 for each row of :func:`described`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(model.chance(_matrix(b)))], names=["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {dict(features.dtypes)['doc_id']}, score double")


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows whose crc32 of the id as text leaves ``part``; a null id counts as the empty text."""
    return F.pmod(crc(doc_id), F.lit(parts)) == part


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.7, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``; held-out rows take no part in training.

    A score depends on the text alone, null being empty; repeated rows score alike; no rows give no rows.
    """
    found = described(docs, doc_id, text)
    model = fit(found, labels, ~held_out(F.col("doc_id")), doc_id=doc_id, **options)
    scored = score(found, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.7, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, whole. Texts are described a second time, so that they need not be shuffled."""
    model = fit(described(docs, doc_id, text), labels, ~held_out(F.col("doc_id")), doc_id=doc_id, **options)

    name = fresh(docs, "_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b[text].to_pylist()]).reshape(-1, len(FEATURES))
            yield b.append_column(name, pa.array(model.chance(x)))

    shape = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, shape).where(F.col(name) >= least).drop(name)
