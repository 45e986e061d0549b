import random

from llm_data import SMALL, read
from pyspark.sql import functions as F

from tidemark.llm import chat


def told(events):
    """Messages, loss texts and formatted text per conversation, read back."""
    back = chat.read_back(chat.render(chat.fold(events))).collect()
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learnt, r.formatted) for r in back}


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, msg long, kind string, role string, text string, extra string")


def folded(rows):
    """One conversation, one event at a time."""
    held = {}
    rank = {"regenerate": 0, "message": 1, "edit": 2, "delta": 3}
    for _, _, msg, kind, role, text, _ in sorted(rows, key=lambda r: (r[1], rank[r[3]], r[5] or "")):
        if kind == "regenerate":
            held = {m: v for m, v in held.items() if m < msg}
            continue
        old_role, old = held.get(msg, ("", ""))
        held[msg] = (max(old_role, role or ""), old + text if kind == "delta" else text)
    return [held[m] for m in sorted(held)]


def test_fold_equals_event_by_event(spark):
    r = random.Random(8)
    rows = []
    for conv in range(60):
        seqs = r.sample(range(100), 14)
        for seq in seqs:
            kind, msg = r.choice(["message", "delta", "delta", "edit", "regenerate"]), r.randrange(4)
            rows.append((conv, seq, msg, kind, ["user", "assistant"][msg % 2], r.choice(["a", "bc ", "<s>", "\\", "é\n"]), "x"))
    rows_shuffled = r.sample(rows, len(rows))
    got = told(events(spark, rows_shuffled))
    for conv in range(60):
        want = folded([x for x in rows if x[0] == conv])
        turns = got[conv][0] if conv in got else []
        # the role of a message is that of any event that is left; both belong to its place here
        assert turns == [(["user", "assistant"][["user", "assistant"].index(a)], t) for a, t in want], conv


def test_any_text_comes_back(spark):
    r = random.Random(9)
    pieces = [*chat.CONTROL, "\\", "<", "|", "[", "]", "INST", "s>", "im_end|>", "</", "\n", "é", "😀", " ", "a", "$1"]
    rows = []
    for conv in range(150):
        for turn in range(r.randrange(1, 5)):
            text = "".join(r.choice(pieces) for _ in range(r.randrange(12)))
            role = r.choice(["user", "assistant", "system", "<|im_sep|>\\odd\nrole"])
            rows.append((conv, turn, turn, "message", role, text, None))
    got = told(events(spark, rows))
    for conv in range(150):
        own = [x for x in rows if x[0] == conv]
        turns, learnt, formatted = got[conv]
        assert turns == [(x[4], x[5]) for x in own]
        assert learnt == [x[5] for x in own if x[4] == "assistant"]
        marks = len(own)
        for c in chat.CONTROL:
            assert formatted.count(c) == (marks if c in (chat.START, chat.SEP, chat.END) else 0)


def test_odd_events(spark):
    rows = [
        (1, 0, 0, "message", None, None, None), (1, 0, 0, "message", None, None, None), (1, None, None, "message", "user", "first", None),
        (None, 1, 0, "message", "assistant", "no conversation", None), (2, 1, 0, "unknown kind", "user", "x", None),
        (3, 1, 0, "message", "user", "gone", None), (3, 2, 0, "regenerate", "user", None, None), (4, 1, 0, "message", "assistant", "y" * 300_000, None),
    ]
    got = told(events(spark, rows))
    assert got[1][0] == [("user", "first"), ("", ""), ("", "")]
    assert got[None][1] == ["no conversation"]
    assert 2 not in got and 3 not in got
    assert got[4][1] == ["y" * 300_000]
    assert told(events(spark, rows).limit(0)) == {}


def test_table_comes_back(spark):
    turns = read(spark, SMALL, "conversations")
    got = told(chat.as_events(turns))
    want = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert {k: v[0] for k, v in got.items()} == want
    assert {k: "".join(v[1]) for k, v in got.items()} == {k: "".join(t for a, t in v if a == "assistant") for k, v in want.items()}
    assert chat.read_back(chat.render(chat.fold(chat.as_events(turns)))).where(F.col("formatted").isNull()).count() == 0


def test_streamed_logs_give_the_same_messages(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("user", "hi"), ("assistant", ""), ("user", None), (None, "é漢😀\n</s>\\"), ("assistant", "x" * 1000)])]
    rows += [(None, 1, "user", "n"), (7, 1, "user", "again"), (7, 1, "user", "again"), (8, None, "user", "no turn"), (9, -5, "assistant", "before")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.as_streamed(turns)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    plain, streamed = (sorted(map(str, chat.fold(e).select("conv_id", "msg", "n", "role", "text").collect())) for e in (chat.as_events(turns), log))
    assert plain == streamed
