import random
import re

import pytest
from llm_data import MIDDLE, odd_documents, read

from tidemark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, size):
    windows = {}
    for name, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add(name)
    out = []
    for i, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                found = windows.get(tuple(w[a : a + n]))
                if found:
                    hit |= set(range(a, a + n))
                    names |= found - {None}
        out.append((i, len(w), sorted(hit), sorted(map(str, names))))
    return sorted(map(str, out))


def told(df):
    return sorted(map(str, ((r.doc_id, r.n_words, [x for h in r.hits for x in range(h.first, h.end)], list(r["items"])) for r in df.collect())))


def texts(seed):
    r = random.Random(seed)
    words = ["Ab", "cd", "éf", "x1", "ZZ", "q", "漢", "10"]
    line = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "--", "\n", "' ", "_"]) for _ in range(n))
    items = [(i, line(r.choice([1, 2, 3, 4, 6, 9]))) for i in range(25)] + [(None, line(5)), (3, "cd cd cd"), (90, None), (91, " .. ")]
    docs = [(i, line(r.randrange(60))) for i in range(80)] + [(200, items[5][1] * 3), (201, None), (None, items[2][1]), (201, "")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 20, 200])  # 200 bytes: several automata
def test_equals_brute_force(spark, limit):
    docs, items = texts(limit)
    df = odd_documents(spark, [(i, t, "s") for i, t in docs])
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert told(decontaminate.contamination(df, asked, size=4, limit=limit)) == brute(docs, items, 4)


def test_table_odd_and_empty(spark, odd, empty):
    items = read(spark, MIDDLE, "benchmark")
    own = [tuple(r) for r in items.collect()]
    docs = read(spark, MIDDLE, "documents").select("doc_id", "text")
    assert told(decontaminate.contamination(docs, items)) == brute([tuple(r) for r in docs.collect()], own, 10)
    assert told(decontaminate.contamination(odd, items)) == brute([(r.doc_id, r.text) for r in odd.collect()], own, 10)
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).where("size(hits) > 0").count() == 0


def test_spans_point_into_the_original(spark):
    item = "The Quick brown Fox jumps over the lazy dog's back"
    text = "Ünfamed 😀 intro... the QUICK, brown fox-jumps over the lazy\ndog s BACK! and more"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = decontaminate.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert [text[s.start : s.end] for s in r.spans] == ["the QUICK, brown fox-jumps over the lazy\ndog s BACK"]


def test_contaminated_documents_go(spark):
    docs, items = texts(7)
    df = odd_documents(spark, [(i, t, "s") for i, t in docs])
    asked = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.drop_contaminated(df, asked, size=4)
    want = [x for x in map(eval, brute(docs, items, 4)) if not x[2]]
    assert kept.columns == df.columns and kept.count() == len(want)
