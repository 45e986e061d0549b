"""Chat formatting from an event log. DataFrame functions only.

A log holds what happened to conversations, in the order of ``seq``: whole messages, streamed deltas, edits and regenerations. Folding it
gives the final messages, which are rendered with a template that marks turns; control strings inside texts are escaped, so the output
can be read back exactly. All steps share one partitioning by conversation: windows mark the events that still count, one grouping
joins the pieces of a message, another the messages of a conversation. A conversation is one output row, so its events meet in one task
and its final text must fit in a row, whatever its share of the table; nothing else is bounded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"

# Control strings of common chat templates. None holds a backslash.
CONTROL = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>",
    "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
)


def _literal(text: str) -> str:
    return re.escape(text)


def escape(text: Column, control: tuple[str, ...] = CONTROL) -> Column:
    """Doubles backslashes, then puts one backslash after the first character of every control string, overlapping ones too."""
    out = F.regexp_replace(text, r"\\", r"\\\\")
    for first in sorted({c[0] for c in control}):
        rest = "|".join(_literal(c[1:]) for c in control if c[0] == first)
        out = F.regexp_replace(out, f"{_literal(first)}(?={rest})", f"{_literal(first)}\\\\")
    return out


def unescape(text: Column) -> Column:
    """Undoes :func:`escape`: a pair of backslashes is one, a single one goes (escapes never stand before a backslash)."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Event log -> final messages: ``conv_id, msg, n, role, text``.

    ``events`` has ``conv_id, seq, msg`` (place of the message), ``kind, role, text``. In the order of ``seq`` (null first), ``message``
    and ``edit`` set the text of ``msg``, ``delta`` appends to it, ``regenerate`` empties it and removes all later messages, whose
    places may then be taken anew. A message of which nothing is left is gone. At one ``seq``, regenerations come first and deltas last; an
    edit wins over messages, the greater text over lesser edits, and whole messages of one place and ``seq`` all stay, numbered in ``n`` (a log
    of whole turns may repeat rows). Null texts are empty; a null role is taken from another event of the message, else
    empty. A null ``conv_id`` is a conversation of its own, a null ``msg`` a place before all others. Other kinds and extra columns are ignored; no rows
    give no rows.
    """
    first = F.lit(-(2**62))
    e = events.where(F.col("kind").isin("message", "delta", "edit", "regenerate")).select(
        "conv_id",
        F.coalesce(F.col("seq").cast("long"), first).alias("seq"),
        F.coalesce(F.col("msg").cast("long"), first).alias("msg"),
        "kind",
        "role",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    again = F.col("kind") == "regenerate"
    backwards = W.partitionBy("conv_id").orderBy(F.col("seq").desc(), again.cast("int")).rowsBetween(W.unboundedPreceding, -1)
    e = e.select("*", F.min(F.when(again, F.col("msg"))).over(backwards).alias("_cut"))
    e = e.where(~again & (F.col("_cut").isNull() | (F.col("_cut") > F.col("msg"))))

    place = W.partitionBy("conv_id", "msg")
    edit, whole = F.col("kind") == "edit", F.col("kind") != "delta"
    setting = F.struct(F.col("seq").alias("seq"), edit.alias("edit"), F.when(edit, F.col("text")).otherwise("").alias("text"))
    e = e.select("*", F.max(F.when(whole, setting)).over(place).alias("_set"))
    e = e.where(F.col("_set").isNull() | F.when(whole, setting == F.col("_set")).otherwise(F.col("seq") >= F.col("_set.seq")))
    number = F.row_number().over(place.orderBy(~whole, "role", "text"))
    e = e.select("*", F.when(whole, number).otherwise(1).alias("n")).where(~edit | (F.col("n") == 1))
    piece = F.struct("seq", (~whole).alias("delta"), "text")
    return e.groupBy("conv_id", "msg", "n").agg(
        F.coalesce(F.max("role"), F.lit("")).alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Messages -> ``conv_id, formatted, loss``: the text of a conversation, and the spans (``start``, ``bytes``) under the loss mask.

    Spans count bytes of the UTF-8 form and cover the escaped texts of the roles in ``learn``, without marks. Messages stand in the order
    of ``msg``, then ``n``.
    """
    m = messages.select(
        "conv_id",
        F.struct("msg", "n", "role", "text").alias("at"),
        F.concat(F.lit(START), escape(F.coalesce(F.col("role"), F.lit(""))), F.lit(SEP)).alias("head"),
        escape(F.coalesce(F.col("text"), F.lit(""))).alias("body"),
        F.col("role").isin(*learn).alias("learnt"),
    )
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    before = W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    m = m.select("*", (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.octet_length("head")).alias("start"))
    row = F.struct(
        "start", F.concat("head", "body", F.lit(END)).alias("piece"), F.octet_length("body").alias("bytes"), F.coalesce("learnt", F.lit(False)).alias("learnt")
    )
    g = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return g.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("rows", lambda x: x["learnt"]), lambda x: F.struct(x["start"].alias("start"), x["bytes"].alias("bytes"))
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted, loss`` -> ``turns`` (array of role and text) and ``learnt`` (texts under the loss mask), both unescaped."""
    rest = [c for c in formatted.columns if c not in ("formatted", "loss")]
    df = formatted.select(*rest, "formatted", "loss", F.encode("formatted", "UTF-8").alias("_bytes"))
    parts = F.filter(F.split("formatted", _literal(END)), lambda x: x != "")
    sep = F.transform(parts, lambda x: F.split(F.substring_index(x, START, -1), _literal(SEP), 2))
    return df.select(
        *rest,
        "formatted",
        "loss",
        F.transform(sep, lambda x: F.struct(unescape(x[0]).alias("role"), unescape(x[1]).alias("text"))).alias("turns"),
        F.transform("loss", lambda s: unescape(F.decode(F.substring(F.col("_bytes"), s["start"].cast("int") + 1, s["bytes"]), "UTF-8"))).alias("learnt"),
    )


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of turns as an event log: each row is a whole message at its turn."""
    return conversations.select(
        "conv_id", F.col("turn").alias("seq"), F.col("turn").alias("msg"), F.lit("message").alias("kind"), "role", "text"
    )


def as_streamed(conversations: DataFrame) -> DataFrame:
    """The same turns as a log of what led to them; folding it gives the same messages as :func:`as_events`.

    By a hash of conversation and turn, a turn is a whole message, three deltas, a draft and the edit that replaces it, or a wrong answer that is
    regenerated and streamed anew. Of a message and its edit both name the role, of deltas only the first. Turns that stand more than once in a conversation, or
    have a null number, stay whole messages.
    """
    steps = 8
    place = W.partitionBy("conv_id", "turn")
    t = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.count("*").over(place).alias("_copies"))
    way = F.when((F.col("_copies") > 1) | F.col("turn").isNull(), 0).otherwise(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)))
    text, third = F.col("text"), F.ceil(F.length("text") / 3).cast("int")
    none = F.lit(None).cast("string")

    def event(step: int, kind: str, text: Column, first: bool = False) -> Column:
        return F.struct(
            F.lit(step).alias("step"), F.lit(kind).alias("kind"), (F.col("role") if first else none).alias("role"), text.alias("text"))

    pieces = [F.substring(text, 1, third), F.substring(text, third + 1, third), F.substring(text, 2 * third + 1, third)]
    wrong = F.concat(F.lit("draft of "), F.reverse(text))
    log = (
        F.when(way == 1, F.array(*[event(k, "delta", p, k == 0) for k, p in enumerate(pieces)]))
        .when(way == 2, F.array(event(0, "message", wrong, True), event(1, "edit", text, True)))
        .when(way == 3, F.array(event(0, "message", wrong, True), event(1, "delta", F.lit(" and more")), event(2, "regenerate", none),
                                *[event(3 + k, "delta", p, k == 0) for k, p in enumerate(pieces)]))
        .otherwise(F.array(event(0, "message", text, True)))
    )
    e = t.select("conv_id", "turn", F.explode(log).alias("e"))
    return e.select("conv_id", (F.col("turn") * steps + F.col("e.step")).alias("seq"), F.col("turn").alias("msg"), "e.kind", "e.role", "e.text")
