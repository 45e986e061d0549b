import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
import zstandard
from llm_data import MIDDLE, odd_documents, read

from tidemark.llm import rolling, substrings


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    often = Counter(t[a : a + length] for _, t in data for a in range(len(t) - length + 1))
    out = []
    for i, t in data:
        cover = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if often[t[a : a + length]] > 1:
                cover[a : a + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        out.append((i, len(t), sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), kept))
    return sorted(map(str, out))


def told(df, **options):
    return sorted(map(str, ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.remove_repeats(df, **options).collect())))


def texts(seed):
    r = random.Random(seed)
    words = ["ab", "cde", "é", "xyz", "q" * 7, "foo", "bar\n", "lorem"]
    base = "".join(r.choice(words) + " " for _ in range(200))
    rows = [(i, "".join(r.choice(words) + str(r.randrange(30)) for _ in range(r.randrange(120)))) for i in range(40)]
    for i in range(40, 90):
        a, n = r.randrange(500), r.randrange(50, 300)
        rows.append((i, "".join(r.choice(words) + str(r.randrange(99)) for _ in range(20)) + base[a : a + n] + "Z" * r.randrange(100)))
    return [*rows, (None, base), (None, None), (7, ""), (7, base), (7, base), (3, "aaaa" * 100), (4, "Thh " * 200)]


@pytest.mark.parametrize(("length", "span", "most"), [(60, 20, 100_000), (60, 20, 1), (80, 49, 100_000), (63, 32, 3)])
def test_equals_brute_force(spark, length, span, most):
    rows = texts(length + most)
    df = odd_documents(spark, [(i, t, "s") for i, t in rows])
    assert told(df, length=length, span=span, most=most) == brute(rows, length)


def test_long_texts_pass_in_segments(spark, monkeypatch):
    rows = texts(2)
    data, offsets = rolling.utf8(__import__("pyarrow").array([t for _, t in rows]))
    whole = substrings.phrases(data, offsets, 60, 20)
    monkeypatch.setattr(substrings, "SEGMENT", 997)
    parts = substrings.phrases(data, offsets, 60, 20)
    starts = lambda f: sorted((r, i) for r, lo, hi in zip(f["row"], f["lo"], f["hi"]) for i in range(lo, hi + 1))
    assert starts(parts) == starts(whole)  # every start belongs to one phrase, wherever segments are cut
    assert set(parts["core"].tolist()) == set(whole["core"].tolist())


def test_table_and_odd_rows(spark, odd, empty):
    docs = read(spark, MIDDLE, "documents").select("doc_id", "text").limit(300)
    assert told(docs) == brute([tuple(r) for r in docs.collect()], 400)
    assert told(odd) == brute([(r.doc_id, r.text) for r in odd.collect()], 400)
    assert substrings.remove_repeats(empty).count() == 0


def test_a_crowded_core_is_counted_by_spark(spark):
    """Near copies of one passage, more starts than ``most``: the same result as in one task."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(k, f"{k} x{k % 7} {base} y{k % 11} {k * k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(df, length=80, span=40, most=500) == told(df, length=80, span=40) == brute(rows, 80)


def held_at_most(work):
    """MB that ``work`` holds at once, counted by Python and numpy."""
    rolling._powers.cache_clear()
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def entries(texts, cores, length):
    """Batches of entries with all their starts, as ``_compare`` gets them."""
    for i in range(0, len(texts), 512):
        t, n = texts[i : i + 512], len(texts[i : i + 512])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(i, i + n), pa.int64()), pa.array([5] * n, pa.int32()), pa.array([3] * n, pa.int32()),
                pa.array([3 + len(x) - length for x in t], pa.int32()), pa.array([3] * n, pa.int32()),
                pa.array(cores[i : i + 512], pa.int64()), pa.array([False] * n), pa.array(t, pa.binary()),
            ],
            names=["id", "fp", "lo", "hi", "at", "core", "known", "bytes"],
        )


def test_memory_of_a_worker_does_not_follow_its_input():
    """Texts of a batch, and entries of one core, are hashed in pieces; only keys are held until a core is complete."""
    r = random.Random(5)
    texts = [r.randbytes(2000) for _ in range(4000)]  # 8 MB
    data, offsets = rolling.utf8(pa.array(texts, pa.binary()))
    assert held_at_most(lambda: substrings.phrases(data, offsets, 400, 256)) < 60
    one_core = list(entries([r.randbytes(410) for _ in range(20_000)], [1] * 20_000, 400))  # 8 MB
    assert held_at_most(lambda: list(substrings._compare(400)(iter(one_core)))) < 60


@pytest.mark.parametrize("starts_at_once", [1, 40, 1000, 10**6])
def test_cores_are_compared_whole_however_many_are_held(starts_at_once):
    r = random.Random(6)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randrange(60, 75))) for _ in range(2000)]
    texts = [t[:50] + b"a" * (len(t) - 50) if i % 3 else b"b" * len(t) for i, t in enumerate(texts)]
    cores = sorted(r.choice([*range(300), 7, 7, 7]) << 40 for _ in texts)
    often = Counter((c, a, t[a : a + 60]) for c, t in zip(cores, texts, strict=True) for a in range(len(t) - 59))
    hit = {(i, 3 + a) for i, (c, t) in enumerate(zip(cores, texts, strict=True)) for a in range(len(t) - 59) if often[c, a, t[a : a + 60]] > 1}
    found = [x for b in substrings._compare(60, starts_at_once)(entries(texts, cores, 60)) for x in b.to_pylist()]
    assert hit and {(x["id"], a) for x in found for a in range(x["a"], x["b"] - 59)} == hit
    assert {x["fp"] for x in found} == {5}


def test_entries_are_cut_in_batches_of_bounded_size(monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 1000)
    r = random.Random(7)
    texts = [r.randbytes(r.choice([70, 900, 5000])) for _ in range(40)]
    own = [[(a, a + r.randrange(9)) for a in range(0, len(t) - 69, 17)] if i % 5 else [] for i, t in enumerate(texts)]
    shape = pa.list_(pa.struct([(k, pa.int32()) for k in ("lo", "hi", "at")] + [("core", pa.int64()), ("known", pa.bool_()), ("crowd", pa.bool_())]))
    rows = [[{"lo": a, "hi": b, "at": a, "core": i, "known": False, "crowd": False} for a, b in x] for i, x in enumerate(own)]
    packed = [zstandard.ZstdCompressor().compress(t) for t in texts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40), pa.int64()), pa.array([1] * 40, pa.int32()), pa.array(packed, pa.binary()), pa.array(rows, shape)],
        names=["id", "fp", "packed", "entries"],
    )
    out = list(substrings._cut(60)(iter([batch])))
    assert max(sum(map(len, b["bytes"].to_pylist())) for b in out) < 1000 + 70
    got = [(x["id"], x["core"], x["lo"], x["hi"], x["bytes"]) for b in out for x in b.to_pylist()]
    assert got == [(i, i, a, b, t[a : b + 60]) for i, t in enumerate(texts) for a, b in own[i]]
