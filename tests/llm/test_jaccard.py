import re
from collections import defaultdict

import numpy as np
import pytest
from llm_data import MIDDLE, near_copies, odd_documents, prose, read
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.groups import components, forest


def brute(rows, threshold=0.8, k=5):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    holders = defaultdict(list)
    for x, own in enumerate(sets):
        for g in own:
            holders[g].append(x)
    links, root = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, own in enumerate(sets):
        common = defaultdict(int)
        for g in own:
            for y in holders[g]:
                common[y] += 1
        for y, n in common.items():
            if y != x and n / (len(own) + len(sets[y]) - n) >= threshold:
                links[x] += 1
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for x in range(len(sets)):
        members[find(x)].append(rows[x][0])
    name = {c: min(ids, key=lambda v: -(2**63) if v is None else v) for c, ids in members.items()}
    return sorted(map(str, ((rows[x][0], name[find(x)], links[x]) for x in range(len(sets)))))


def told(df, **options):
    return sorted(map(str, ((r.doc_id, r.class_id, r.n_links) for r in jaccard.similar(df, **options).collect())))


@pytest.mark.parametrize("bucket", [1024, 8])  # 8: oversize buckets and groups are cut into blocks
def test_links_and_classes_equal_brute_force(spark, bucket):
    texts = [*near_copies(3, 60), *near_copies(4, 30, edits=9), *prose(5, 30)]
    rows = [*enumerate(texts), (900, None), (901, ""), (902, "a b"), (903, "a  b\n"), (None, "a b c"), (None, texts[0]), (7, texts[7]), (7, texts[7])]
    assert told(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket) == brute(rows)


def test_table_equals_brute_force(spark):
    docs = read(spark, MIDDLE, "documents").select("doc_id", "text")
    assert told(docs) == brute([tuple(r) for r in docs.collect()])


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert told(odd) == brute(rows)
    assert jaccard.similar(empty).count() == 0


def test_one_of_each_class_stays(spark):
    rows = [*enumerate(near_copies(3, 20)), (100, "alone in the world it is"), (7, None), (None, "x y z"), (None, "x y z")]
    docs = odd_documents(spark, [(i, t, "s") for i, t in rows] + [(0, rows[0][1], "s")])
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    classes = {c for _, c, _ in map(eval, brute([(r.doc_id, r.text) for r in docs.collect()]))}
    got = kept.select("doc_id").collect()
    assert len(got) == len(classes) and {r.doc_id for r in got} == classes


def test_forest_and_components(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 220), rng.integers(0, 300, 220)
    a, b = np.append(a, np.arange(300, 399)), np.append(b, np.arange(301, 400))  # and a long chain
    want = forest(400, a, b)
    found = components(spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {i: int(r) for i, r in enumerate(want) if r != i}
    assert components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).limit(0)).count() == 0


def test_samples_of_similar_pairs_agree_often_enough():
    from inspect import signature
    from math import ceil, comb

    own = signature(jaccard.similar).parameters
    p, n = own["threshold"].default, jaccard.SAMPLES
    cut = ceil(n * (p - own["slack"].default) - 1e-9)
    assert sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(cut)) < 1e-6
