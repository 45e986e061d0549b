import random
import zlib

import numpy as np
import pytest
from llm_data import MIDDLE, odd_documents, prose, read

from tidemark.llm import boosting, quality


def naive(trees, x):
    total = trees.base
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        at = 0
        while at < len(f):
            at = 2 * at + (2 if x[f[at]] > t[at] else 1)
        total += leaf[at - len(f)]
    return 1 / (1 + np.exp(-total))


def test_flattened_trees_equal_a_walk_down_each():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] * x[:, 0] > 0)).astype(float)
    trees = boosting.train(x, y, trees=25, depth=5)
    assert np.allclose(trees.chance(x[:200]), [naive(trees, r) for r in x[:200]])
    assert ((trees.chance(x) > 0.5) == y).mean() > 0.93
    again = boosting.Trees.unpack(trees.pack())
    assert np.array_equal(again.chance(x), trees.chance(x))


@pytest.mark.parametrize("y", [np.zeros(0), np.ones(4), np.zeros(4)])
def test_one_kind_of_label_gives_its_share(y):
    trees = boosting.train(np.ones((len(y), 3)), y)
    assert np.allclose(trees.chance(np.ones((2, 3))), (y.sum() + 1) / (len(y) + 2))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 500 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in held)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.98
    good = [r for r in held if r.quality]
    assert np.mean([r.predicted for r in good]) > 0.99


def test_scores_depend_on_texts_alone(spark, odd, empty):
    labels = read(spark, MIDDLE, "labels")
    rows = quality.classify(odd, labels).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in odd.collect()}
    by_text = {}
    for r in rows:
        if r.doc_id in (2, 3, 5):
            by_text.setdefault(texts[r.doc_id] or "", set()).add(r.score)
    assert all(len(v) == 1 for v in by_text.values())
    assert quality.classify(empty, labels).count() == 0
    assert quality.classify(odd, labels.limit(0)).where("score = 0.5").count() == odd.count()


def test_bad_documents_go(spark):
    r = random.Random(1)
    good = prose(2, 300)
    bad = [" ".join(w + r.choice(["***", "$$$"]) for w in t.split()) for t in prose(3, 300)]
    docs = odd_documents(spark, [*((i, t, "a") for i, t in enumerate(good)), *((1000 + i, t, "b") for i, t in enumerate(bad))])
    labels = spark.createDataFrame([*((i, 1) for i in range(0, 300, 2)), *((1000 + i, 0) for i in range(0, 300, 2))], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(range(300))


def test_statistics_of_odd_texts():
    for t in (None, "", " ", "a", "\n\n", "é" * 10000, "x " * 100_000):
        found = quality.statistics(t)
        assert len(found) == len(quality.FEATURES) and np.isfinite(found).all()
