import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import MIDDLE, read
from pyspark.sql import functions as F

from tidemark.llm import brown


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), b""]


def base(rows, learn):
    often = Counter(w for i, t in rows if learn(i) for w in tokens(t))
    n, v = sum(often.values()), len(often)
    return n, {(i, t): (len(tokens(t)), sum(often[w] > 0 for w in tokens(t)), sum(math.log10((often[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows}


@pytest.mark.parametrize("head", [200_000, 40])  # 40: nearly all words come by the join
def test_base_is_exact_and_classes_beat_it(spark, head):
    docs = read(spark, MIDDLE, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, want = base(rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    held = brown.held_out(F.col("doc_id"))
    got = brown.score(docs, brown.fit(docs.where(~held), head=head)).withColumn("held", held).collect()
    text = dict(rows)
    for r in got:
        size, known, value = want[(r.doc_id, text[r.doc_id])]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n) and math.isclose(r.base_score, value, rel_tol=1e-9)
        assert math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)
    out = [r for r in got if r.held]
    assert len(out) > 100 and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_of_all_words_sum_to_one(spark):
    docs = read(spark, MIDDLE, "documents").limit(60)
    model = brown.fit(docs, clustered=50, groups=16, classes=8)
    items = brown.Items(model.common, model.groups)
    mass = np.zeros(8)
    for r in model.counts.collect():
        c = model.own[items.of(bytes(r.word))]
        mass[c] += 10 ** (math.log10(r.n + 1) - model.spread[c])
    used = np.unique(model.own)
    for c in used:  # and the rest of 1 for a word never seen
        assert math.isclose(mass[c] + 10 ** -model.spread[c], 1, rel_tol=1e-9)
    assert np.allclose((10**model.step).sum(axis=1), 1)


def test_exchange_finds_two_kinds_of_words():
    rng = np.random.default_rng(1)
    pairs = np.zeros((21, 21))  # 1-10 are followed by 11-20 and the other way round; 0 ends texts
    for _ in range(5000):
        a, b = rng.integers(1, 11), rng.integers(11, 21)
        pairs[a, b] += 1
        pairs[b, rng.integers(1, 11)] += 1
    pairs[0, 1:] = pairs[1:, 0] = 1
    own = brown.exchange(pairs, 3)
    assert own[0] == 0 and len(set(own[1:11])) == 1 and len(set(own[11:])) == 1 and own[1] != own[11]


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    n, want = base(rows, lambda i: True)
    model = brown.fit(odd, head=5)
    got = sorted(map(str, ((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in brown.score(odd, model).collect())))
    assert got == sorted(map(str, ((i, want[(i, t)][0], want[(i, t)][1], round(want[(i, t)][2], 6)) for i, t in rows)))
    assert model.tokens == n and brown.score(empty, model).count() == 0
    blank = brown.fit(empty)
    r = brown.score(odd.where("doc_id = 1"), blank).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (1, 0, 0) and math.isfinite(r.score)


def test_all_frequent_words_choose_their_class(spark):
    rng = np.random.default_rng(2)  # a- and b-words take turns; all end alike, and two of them are seeds
    kinds = [[f"{k}{i:02}same" for i in range(30)] for k in "ab"]
    texts = [(i, " ".join(kinds[(i + j) % 2][rng.integers(0, 30)] for j in range(40))) for i in range(100)]
    model = brown.fit(spark.createDataFrame(texts, "doc_id long, text string"), clustered=2, groups=1, classes=3)
    items = brown.Items(model.common, model.groups)
    a, b = ({int(model.own[items.of(w.encode())]) for w in kind} for kind in kinds)
    assert len(model.common) == 60 and len(a) == len(b) == 1 and a != b


def test_many_moves_at_once_are_those_of_one():
    rng = np.random.default_rng(3)
    pairs = rng.poisson(2.0, (30, 30)).astype(float)
    own = np.append(0, 1 + np.arange(29) % 4)
    member = np.eye(5)[own]
    between, (r, c) = member.T @ pairs @ member, (pairs @ member, pairs.T @ member)
    got = brown.best_class(between, own, r, c, np.diag(pairs).copy())
    for i in range(1, 30):
        values = []
        for k in range(1, 5):
            m = member.copy()
            m[i] = np.eye(5)[k]
            values.append(brown._likelihood(m.T @ pairs @ m))
        assert got[i] == 1 + int(np.argmax(values))


def test_class_tables_are_bounded(spark):
    docs = read(spark, MIDDLE, "documents")
    small, large = (brown.fit(docs, clustered=20, groups=8, classes=6, most=m) for m in (40, 10**6))
    assert 30 <= len(small.common) <= 40 < len(large.common) and len(small.own) == 1 + len(small.common) + 8
    totals = [brown.score(docs, m).agg(F.sum("score")).first()[0] for m in (small, large)]
    assert totals[1] > totals[0]  # what the bound costs


def test_a_document_costs_its_own_words():
    """2,000 short documents after one with 300,000 words: what a worker remembers doesn't slow it down."""
    head = {f"w{i}".encode(): 2 for i in range(300_000)}
    items = brown.Items(np.zeros(0, np.uint64), 16, most=400_000)
    items.numbers(list(head))
    assert len(items.known) == 300_000
    lines = [[f"w{(i * 37 + j) % 300_000}".encode() for j in range(40)] for i in range(2000)]
    start = time.perf_counter()
    for line in lines:
        items.numbers(line)
    assert (time.perf_counter() - start) / len(lines) < 1e-3


def test_changes_of_a_turn_are_those_of_counting_anew():
    rng = np.random.default_rng(5)
    size, classes = 40, 6
    pairs = rng.poisson(1.5, (size, size))
    shares, rows = brown.share_of(np.arange(size)), []
    for i in range(size):
        after, before = np.flatnonzero(pairs[i]), np.flatnonzero(pairs[:, i])
        other, n = np.append(after, size + before), np.append(pairs[i, after], pairs[before, i])
        rows.append((int(shares[i]), brown._pack(np.full(len(other), i), other, n)))
    own = np.append(0, 1 + rng.integers(0, classes - 1, size - 1)).astype(np.int16)
    trial = own.copy()
    movers = np.flatnonzero((shares == 3) & (np.arange(size) > 0))
    trial[movers] = 1 + rng.integers(0, classes - 1, len(movers))
    table = lambda c: np.eye(classes)[c].T @ pairs @ np.eye(classes)[c]

    class Sent:
        value = (own, trial, table(own), 4)

    batch = pa.record_batch({"share": pa.array([s for s, _ in rows if s in (3, 4)], pa.int32()), "cells": pa.array([c for s, c in rows if s in (3, 4)], pa.binary())})
    found = list(brown._turn(Sent, classes)(iter([batch])))[0].to_pylist()[0]
    assert np.array_equal(table(own) + np.frombuffer(found["change"]).reshape(classes, classes), table(trial))
    moved = np.frombuffer(found["moves"], np.int64).reshape(2, -1)
    assert set(moved[0]) <= set(np.flatnonzero(shares == 4))


def test_words_of_many_texts_are_those_of_each():
    draw = np.random.default_rng(4)
    texts = [None, "", " ", "\x0b\x0cA b\tB\r\n", "  x", "x  ", "É ÀB\xa0c\u2003d \x1c e\x85f \x00 g"]
    texts += ["".join(draw.choice(list("aBc \t\n\x0b\x0c\r\x1cé\u3000"), draw.integers(0, 40))) for _ in range(500)]
    for part in (pa.array(texts), pa.array(texts)[5:], pa.array(["", None]), pa.array([], pa.string())):
        words, n = brown.split(part)
        assert words.to_pylist() == [w for x in part.to_pylist() for w in tokens(x)[:-1]] and n.tolist() == [len(tokens(x)) - 1 for x in part.to_pylist()]
    rows = pa.table({"row": range(len(texts)), "text": texts})
    for most in (1, 50, 10**6):
        found = list(brown._chunks(iter(rows.to_batches(max_chunksize=7)), most))
        assert pa.concat_tables(found) == rows and (most > 1 or len(found) == len(texts)) and (most < 10**6 or len(found) == 1)


def test_scoring_costs_few_times_the_splitting(spark):
    """Words are looked up once in some megabytes of text, not one by one."""
    docs = read(spark, MIDDLE, "documents").select("doc_id", "text").toArrow().combine_chunks()
    batches = [pa.record_batch({"row": b["doc_id"], "text": b["text"], "doc_id": b["doc_id"]}) for b in docs.to_batches(max_chunksize=512)] * 4

    class Sent:
        value = (np.zeros(0, np.uint64), 128, np.zeros(129, np.int16), np.zeros((1, 1)), np.zeros(1), np.zeros(0, np.uint64), np.zeros(0))

    def seconds(run):
        start = time.process_time()
        run()
        return time.process_time() - start

    plain = min(seconds(lambda: [tokens(x) for b in batches for x in b["text"].to_pylist()]) for _ in range(3))
    assert min(seconds(lambda: list(brown._score(Sent, 5.0)(iter(batches)))) for _ in range(3)) < 1.5 * plain
