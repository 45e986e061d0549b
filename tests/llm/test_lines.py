import hashlib
from collections import defaultdict

import numpy as np
from llm_data import SMALL, odd_documents, read
from pyspark.sql import functions as F

from tidemark.llm import lines

NONE = lines.NONE


def brute(rows):
    rows = [(NONE if i is None else i, t or "") for i, t in rows]
    holders = defaultdict(list)
    for i, t in rows:
        for k in {k for x in t.split("\n") if len(k := x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})) >= 20}:
            holders[k].append(i)
    out = []
    for i, t in rows:
        parts = t.split("\n")
        own = [x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in parts]
        stay = [x for x, k in zip(parts, own) if len(k) < 20 or len(holders[k]) < 3 or max(holders[k]) == i]
        out.append((i, len(parts), len(parts) - len(stay), "\n".join(stay)))
    return sorted(out)


def told(df):
    return sorted((NONE if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect())


COMMON, RARE = "This line is long enough to COUNT é", "  this line is LONG enough as well\t"


def shared(n):
    rows = [(i, f"own line of document {i} that is long\n{COMMON}\n" + (f"{RARE}\n{RARE}" if i % 4 == 0 else "short")) for i in range(n)]
    return [*rows, (n, COMMON.lower().replace("É", "é")), (n, COMMON), (None, COMMON), (3, RARE), (2, None), (1, "")]


def test_equals_brute_force(spark, odd, empty):
    for rows in (shared(30), [(None, COMMON)] * 4, [(5, "12345678901234567890")] * 2):
        docs = odd_documents(spark, [(i, t, "s") for i, t in rows])
        assert told(lines.dedup_lines(docs, batches=3, keys_per_shard=7)) == brute(rows)
    assert told(lines.dedup_lines(odd)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert lines.dedup_lines(empty).count() == 0


def state(index):
    refs = sorted(map(tuple, index.refs.select("k1", "k2", "n_docs", "last").collect()))
    marks = sum(int((np.frombuffer(r.cells, np.uint16) != 0).sum()) for r in index.filters.collect())
    return refs, marks


def test_deleting_undoes_inserting(spark):
    old = spark.createDataFrame([(i, t) for i, t in shared(20) if i is not None], "doc_id long, text string")
    new = spark.createDataFrame([(i + 100, t) for i, t in shared(25) if i is not None], "doc_id long, text string")
    before = lines.insert(lines.empty_index(spark, 3), lines.postings(old))
    both = lines.insert(before, lines.postings(new))
    assert state(both) != state(before)
    after = lines.delete(both, new.select("doc_id"))
    assert state(after) == state(before)
    found = lines.postings(old)
    assert told(lines.clean(old, found, after)) == told(lines.clean(old, found, before))
    gone = lines.delete(after, old)
    assert state(gone) == ([], 0)
    again = lines.insert(gone, found)
    assert state(again)[0] == state(before)[0]


def test_filter_knows_its_keys_and_few_others():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 1000, 50_000):
        keys = rng.integers(0, 2**64, n, dtype=np.uint64)
        keys = np.append(keys, keys[: n // 3])  # repeats
        held = lines.Cuckoo.build(keys)
        assert held.has(keys).all()
        others = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
        assert held.has(others).mean() < 0.001
        assert held.remove(keys).all()
        assert not held.table.any()


def test_kept_text_is_what_the_hash_says(spark):
    rows = shared(6)
    docs = odd_documents(spark, [(i, t, "s") for i, t in rows])
    for r, want in zip(told(lines.dedup_lines(docs)), brute(rows), strict=True):
        assert hashlib.sha256(r[3].encode()).hexdigest() == hashlib.sha256(want[3].encode()).hexdigest()


def test_key_leaves_only_the_filter_that_holds_it(spark):
    def rows(keys, doc):
        return spark.createDataFrame([(k, 1, doc) for k in keys], "k1 long, k2 long, id long")

    few = [(i + 1 << 48) + i for i in range(40)]
    like = [k + (1 << 30) for k in few]  # same mark and bucket in the filters of both batches
    many = like + [(i + 1000 << 48) + i for i in range(4000)]
    anew = [
        lines.insert(lines.empty_index(spark, 1), rows(few, 1).unionByName(rows(few, 3))),
        lines.insert(lines.empty_index(spark, 1), rows(many, 2).unionByName(rows(many, 3))),
    ]
    both = lines.insert(lines.insert(lines.empty_index(spark, 1), rows(few, 1)), rows(many, 2))
    for gone, again, want in ((2, few, anew[0]), (1, many, anew[1])):
        index = lines.delete(both, spark.createDataFrame([(gone,)], "doc_id long"))
        assert state(lines.insert(index, rows(again, 3))) == state(want)


def test_withdrawn_documents_leave_no_trace(spark, odd):
    docs = read(spark, SMALL, "documents").select("doc_id", "text")
    for df, options in ((docs, {}), (odd, {"least": 3})):
        copies = df.where("doc_id is not null").select((F.col("doc_id") + 10**9).alias("doc_id"), F.concat("text", F.lit("\nanother line that only withdrawn documents have")).alias("text"))
        plain, after = (sorted(map(str, lines.dedup_lines(df, withdrawn=w, **options).collect())) for w in (None, copies))
        assert plain == after
