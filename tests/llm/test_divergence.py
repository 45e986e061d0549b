import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import prose
from pyspark.sql import functions as F

from tidemark.llm import divergence, packing, rolling

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.text("abAB é漢😀 .1", max_size=60), st.text("ab", min_size=5, max_size=90))), max_size=8))
def test_counted_terms(rows):
    data, offsets = rolling.utf8(pa.array([t for _, t in rows], pa.string()))
    got = {}
    for found, group, n, n_texts in packing.counted(data, offsets, np.array([g for g, _ in rows], np.int64)):
        for x in zip(found, group.tolist(), n.tolist(), n_texts.tolist(), strict=True):
            assert x[:2] not in got
            got[x[:2]] = x[2:]
    n, n_texts = Counter(), Counter()
    for g, t in rows:
        own = Counter((w.encode(), g) for w in terms(t))
        n.update(own)
        n_texts.update(own.keys())
    assert got == {k: (n[k], n_texts[k]) for k in n}


def test_many_groups_and_wide_terms():
    texts = [f"w{'x' * (i % 40)} {'é' * 20000} b" for i in range(300)]
    data, offsets = rolling.utf8(pa.array(texts))
    got = {(t, g): n for f, gs, ns, _ in packing.counted(data, offsets, np.arange(300) * 300) for t, g, n in zip(f, gs.tolist(), ns.tolist(), strict=True)}
    assert len(got) == 900 and got["é".encode() * 0 + ("é" * 20000).encode(), 300] == 1


def brute(rows, least=3, ranks=200):
    seen, n, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        key = (lang or "", source or "")
        groups.add(key)
        own = terms(text)
        n[key].update(own)
        seen[key[0]].update(set(own))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, k in seen[lang].items() if k >= least)
        all_of = Counter()
        for g in groups:
            if g[0] == lang:
                all_of.update({t: n[g][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = shares(n[lang, source]), shares(all_of)
        parts = {"pair": [], "term": [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if n[lang, source][t] and p[t] > q[t]]}
        for other in groups:
            if other[0] == lang and other[1] != source:
                r = shares(n[other])
                parts["pair"].append((sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other[1]))
        for part, found in parts.items():
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, i, v, k) for k, (v, i) in enumerate(found, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit("x")).withColumn("term", F.lit("x"))
    return sorted(tuple(r) for r in divergence.audit(df.repartition(3), **options).collect())


def test_odd_rows(spark, empty):
    rows = [("en", s, t) for s, t in zip(["a", "b", None, "a", "c"] * 12, prose(5, 60, words=60), strict=True)]
    rows += [("en", "empty", None), ("en", "blank", " . 1 "), (None, "a", "solo words"), (None, None, ""), ("xx", "a", "x y"), ("xx", "b", "x z"), ("xx", "c", "X!"), ("xx", "", "漢字 漢字")]
    rows += [("fr", "a", "long" * 30 + " même"), ("fr", "b", "long" * 30), ("fr", "c", "long" * 30), ("fr", "a", "MÊME"), ("fr", "a", "MÊME")]
    assert audited(spark, rows) == brute(rows)
    assert audited(spark, rows, least=1, ranks=3) == brute(rows, 1, 3)
    assert audited(spark, rows[:0] or [("en", "a", None)]) == []
    assert divergence.audit(empty).count() == 0


def test_terms_of_all_sources_in_parts(spark):
    rows = [("en", f"s{k % 30}", f"common w{k % 4} only{k % 30}") for k in range(300)]
    assert audited(spark, rows) == brute(rows)
    table = pa.table({"lang": ["en"] * 50, "own": [[{"source": f"s{k}", "p": 10 + k + t, "rest": 3} for k in range(20)] for t in range(50)]})
    sums = [Counter(), Counter()]
    for own, at_once in zip(sums, (500, 2_000_000), strict=True):
        for b in divergence._both(at_once)(table.to_batches()):
            for lang, s, i, v in zip(*(b[c].to_pylist() for c in b.schema.names), strict=True):
                own[lang, s, i] += v
    assert sums[0] == sums[1] and len(sums[0]) == 380


def test_workers_count_in_pieces(spark):
    rows = [("en", f"s{k % 3}", t) for k, t in enumerate(prose(6, 90))]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(str, divergence.term_counts(df, most=100).collect())) == sorted(map(str, divergence.term_counts(df).collect()))
