import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_data import MIDDLE, prose, read
from pyspark.sql import functions as F

from tidemark.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def brute(rows, items, buckets=10_000, longest=1, percent=10, least=20):
    def of(run):
        return zlib.crc32(run.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(of, features(text, longest)[1]))
    for text in items:
        t.update(map(of, features(text, longest)[1]))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    found = []
    for doc_id, text in rows:
        n_words, runs = features(text, longest)
        weight = sum(gain[of(r)] for r in runs)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        found.append((n_words >= least, doc_id, len(runs), weight, score))
    able = sorted((x for x in found if x[0]), key=lambda x: (-x[4], x[1] is None, x[1] or 0, -x[3], x[2]))
    n = len(able) * percent // 100
    out = [(*x[1:], k if k <= n else None) for k, x in enumerate(able, 1)] + [(*x[1:], None) for x in found if not x[0]]
    return sorted(map(repr, out))


def drawn(docs, target, **options):
    return sorted(repr(tuple(r)) for r in resampling.resample(docs, target, **options).collect())


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 70_000, "percent": 50}, {"percent": 100, "least": 0}, {"percent": 0}])
def test_whole_table(spark, options):
    docs, target = (read(spark, MIDDLE, t) for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert drawn(docs, target, **options) == brute(rows, [r.text for r in target.collect()], **options)


def test_odd_rows(spark, odd, empty):
    target = spark.createDataFrame([(1, None), (2, ""), (3, "one row words"), (3, "漢字")], "item_id long, text string")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    for options in ({"least": 1, "percent": 60}, {"least": 0, "percent": 100}, {}):
        assert drawn(odd, target, **options) == brute(rows, [r.text for r in target.collect()], **options)
    assert drawn(odd, target.limit(0), least=1, percent=50) == brute(rows, [], least=1, percent=50)
    assert drawn(empty, target) == []
    assert resampling.draw(odd, target, least=1, percent=60).columns == [c for c in odd.columns]


def test_ranks_over_many_runs_and_segments(spark):
    scored = spark.range(20_000).select((F.col("id") * 7919 % 503).alias("score"), F.col("id").alias("key")).repartition(13)
    want = sorted(((r.score, r.key) for r in scored.collect()), key=lambda x: (-x[0], x[1]))
    for segments, samples, most in ((1, 100, 500), (9, 100, 7000), (40, 1_000_000, 20_000), (300, 64, 19_999)):
        got = resampling.ranked(scored, most, [], segments, samples).collect()
        assert len(got) == 20_000
        first = sorted(((r["rank"], r.score, r.key) for r in got if r["rank"]))
        assert first == [(k, *x) for k, x in enumerate(want[:most], 1)]


def test_regular_samples_keep_segments_even(spark):
    scored = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).cast("long").alias("score"), F.col("id").alias("key"))
    cut = resampling.ranked(scored.repartition(8), 50_000, [], 20)
    sizes = cut.withColumn("part", F.floor((F.col("rank") - 1) / 2500)).groupBy("part").count()
    assert sizes.where("count > 2500").count() == 0 and cut.where("rank is null").count() == 0


def test_target_words_are_preferred(spark):
    words = [(t.split() * 3)[:47] for t in prose(3, 400)]
    rows = [(k, " ".join(w[:20] + ["benchmark", "like", "words"] * 9 if k % 10 == 0 else w)) for k, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1, "benchmark like words " * 20_000)], "item_id long, text string")
    found = resampling.draw(docs, target)
    assert found.count() == 40 and found.where("doc_id % 10 = 0").count() == 40
    assert found.exceptAll(docs).count() == 0
