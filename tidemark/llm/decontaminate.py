"""Benchmark decontamination with one Aho-Corasick automaton over the normalised windows of all items.

Texts and items are normalised alike: A-Z lower-cased, words of letters and digits, one blank between words. The automaton holds every window of
an item with a blank at each end, so it matches whole words only, and scans a text once. Matches are mapped to words and from
there to places in the original text.

The automaton is built in the worker from the items' texts, which the driver sends along. What it holds is checked: a window for almost every item
word, so some ``size`` times the items' bytes, with a node of about 40 bytes for each. Beyond ``limit`` bytes of windows the items are
split into more automata, and the texts pass one after the other.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import fresh, scratch, smaller_batches

#: Every byte that is no word character becomes a blank; A-Z become a-z; bytes of longer characters stay.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def windows(text: str | None, size: int) -> set[str]:
    """Windows of ``size`` words, or the one of a shorter item, as the automaton holds them (bytes as Latin-1)."""
    w = normal_words(text)
    return {f" {b' '.join(w[i : i + size]).decode('latin-1')} " for i in range(max(1, len(w) - size + 1))} if w else set()


def automaton(items: list[tuple[str | None, str | None]], size: int) -> ahocorasick.Automaton:
    owners: dict[str, set] = {}
    for name, text in items:
        for w in windows(text, size):
            owners.setdefault(w, set()).add(name)
    found = ahocorasick.Automaton()
    for w, names in owners.items():
        found.add_word(w, (w.count(" ") - 1, names - {None}))
    if owners:
        found.make_automaton()
    return found


def scan(text: str | None, found: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit runs of words (first, end), and the items hit."""
    w = normal_words(text)
    runs: list[tuple[int, int]] = []
    names: set[str] = set()
    if w and len(found):
        ends = None
        for at, (n, owners) in found.iter(f" {b' '.join(w).decode('latin-1')} "):
            if ends is None:
                ends = list(accumulate(map(len, w), lambda a, n: a + 1 + n, initial=0))[1:]
            end = bisect_right(ends, at)
            names |= owners
            first = end - n
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append((first, end))
    return len(w), runs, names


def _scan(sent, size: int, text: str, outs: tuple[str, ...]):
    n_words, hits, found_items, spans = outs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = sent.value  # a worker keeps it from task to task, and the automaton with it
        if "machine" not in told:
            told["machine"] = automaton(told["items"], size)
        machine = told["machine"]
        for b in batches:
            before = zip(b[hits].to_pylist(), b[found_items].to_pylist(), strict=True) if hits in b.schema.names else None
            n, runs, names, places = [], [], [], []
            for whole in b[text].to_pylist():
                count, own, owners = scan(whole, machine)
                if before is not None:
                    old, old_names = next(before)
                    own, owners = _union([(r["first"], r["end"]) for r in old], own), owners | set(old_names)
                n.append(count)
                runs.append([{"first": a, "end": z} for a, z in own])
                names.append(sorted(owners))
                if own:
                    at = [m.span() for m in WORD.finditer(whole)]
                    places.append([{"start": at[a][0], "end": at[z - 1][1]} for a, z in own])
                else:
                    places.append([])
            rest = [c for c in b.schema.names if c not in outs]
            word_run = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            new = [pa.array(n, pa.int64()), pa.array(runs, word_run), pa.array(names, pa.list_(pa.string())), pa.array(places, place)]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in rest], *new], names=[*rest, *outs])

    return run


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted([*a, *b]):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 10, limit: int = 8 << 20,
    outs: tuple[str, str, str, str] = ("n_words", "hits", "items", "spans"),
) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (runs of hit words: first, end), ``items`` (ids as sorted strings), ``spans`` (code points of the text).

    A document word is hit inside any occurrence of ``size`` successive words of an item, or of all words of a shorter one. Null and empty texts have
    no words, items without words no window. An item with a null id hits but isn't listed; repeated items are one, repeated rows
    are judged alike; no items, no hits; no rows give no rows. Columns of ``docs`` named like ``outs`` are replaced.
    """
    spark = docs.sparkSession
    smaller_batches(spark)
    rest = [c for c in docs.columns if c.lower() not in {o.lower() for o in outs}]
    df = docs.select(*[F.col(f"`{c}`") for c in rest])
    told = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")).where("text is not null").distinct()
    words = F.size(F.split(F.trim("text"), r"\s+"))
    windows_ = F.octet_length("text") * F.least(words, F.lit(size))  # a word stands in up to ``size`` windows
    parts = max(1, -(-(told.agg(F.sum(windows_)).first()[0] or 0) // limit))
    runs = ArrayType(StructType([StructField("first", IntegerType()), StructField("end", IntegerType())]))
    places = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
    types = (LongType(), runs, told.select(F.array("id").alias("a")).schema["a"].dataType, places)
    shape = StructType([*df.schema.fields, *[StructField(o, t) for o, t in zip(outs, types, strict=True)]])
    for part in range(parts):
        own = told.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()  # less than ``limit`` bytes
        sent = spark.sparkContext.broadcast({"items": [(r.id, r.text) for r in own]})
        df = df.mapInArrow(_scan(sent, size, text, outs), shape)
        if part + 1 < parts:
            df = scratch(df)  # one automaton at a time in a worker
    return df


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs."""
    outs = tuple(fresh(docs, c) for c in ("_n_words", "_hits", "_items", "_spans"))
    return contamination(docs, items, outs=outs, **options).where(F.size(outs[1]) == 0).drop(*outs)
