"""Removal of repeated substrings: every byte covered by a string of ``length`` bytes that also starts anywhere else.

After prefix-free parsing. A rolling hash picks a trigger in every window of ``span`` hash places, so the parse depends on content alone and
no phrase is longer than ``span``. A phrase here is the run of string starts that share their trigger; its text reaches ``length`` bytes past its
last start. Where parsing with a short overlap needs the order of the whole parse behind a phrase, this overlap makes a phrase's text hold
all that the order is asked for, namely which starts agree for ``length`` bytes. So only the dictionary is ordered:

1. Phrases are counted by core, the bytes that all strings of a trigger share. A core found once ends the matter; that is most unique text.
2. Phrases of equal text are one entry of the dictionary. An entry found twice is repeated as a whole, whatever the number of its copies.
3. Entries found once that share a core with other entries are compared start by start: the suffixes of a core's entries, cut at
   ``length`` bytes, are sorted by hash, and neighbours that agree are repeated.

Equal bytes are told by two independent 64-bit hashes (core and text, or core and suffix). A core whose entries have more than ``most`` starts
isn't gathered in a task: its suffixes are counted by a Spark aggregation, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.common import scratch, smaller_batches

#: Bytes that are hashed at once, with some 100 bytes of memory for each; also the bytes of entries sent on at once.
SEGMENT = 1 << 18
GRAM = 32


def phrases(data: np.ndarray, offsets: np.ndarray, length: int, span: int) -> dict[str, np.ndarray]:
    """Phrases of many texts: ``row``, first and last start ``lo``, ``hi``, trigger ``at`` (in the text), hashes ``core``, ``whole``."""
    found: dict[str, list] = {k: [] for k in ("row", "lo", "hi", "at", "core", "whole")}
    for begin in range(0, len(data), SEGMENT):
        piece = data[begin : begin + SEGMENT + length - 1]
        if len(piece) < length:
            break
        hashes = rolling.Rolling(piece)
        at = rolling.leftmost_minimum(hashes.windows(GRAM), span)[: min(len(piece) - length + 1, SEGMENT)]
        first_row = np.searchsorted(offsets, begin, side="right") - 1
        edges = np.clip(offsets[first_row:] - begin, 0, len(at))
        row = np.repeat(np.arange(first_row, first_row + len(edges) - 1), np.diff(edges))
        starts = np.flatnonzero(np.arange(begin + length, begin + length + len(at)) <= offsets[row + 1])
        if not len(starts):
            continue
        at, row = at[starts], row[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        lo, hi, p, r = starts[first], starts[np.append(first[1:], len(starts)) - 1], at[first], row[first]
        base = offsets[r] - begin
        whole = hashes.pieces(lo, hi + length) ^ rolling.mixed((p - lo).astype(np.uint64) + np.uint64(1))
        for k, v in (
            ("row", r), ("lo", lo - base), ("hi", hi - base), ("at", p - base),
            ("core", hashes.pieces(p, p + length + 1 - span)), ("whole", whole),
        ):
            found[k].append(v)
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}


def _parse(length: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = phrases(*rolling.utf8(b["text"]), length, span)
            rows = pa.array(f["row"])
            yield pa.RecordBatch.from_arrays(
                [
                    b["id"].take(rows), b["fp"].take(rows),
                    *[pa.array(f[k].astype(np.int32)) for k in ("lo", "hi", "at")],
                    *[pa.array(f[k].view(np.int64)) for k in ("core", "whole")],
                ],
                names=["id", "fp", "lo", "hi", "at", "core", "whole"],
            )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = [squeeze.compress((x or "").encode()) for x in b["text"].to_pylist()]
        rest = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[b[n] for n in rest], pa.array(packed, pa.binary())], names=[*rest, "packed"])


def _cut(length: int):
    """Entries of a document -> each entry's own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            lists, e = b["entries"], b["entries"].flatten()
            lo, hi = (e.field(k).to_numpy().astype(np.int64) for k in ("lo", "hi"))
            rows = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy())
            full = np.flatnonzero(np.diff(np.cumsum(hi - lo + length) // SEGMENT)) + 1
            opened, text = -1, b""
            for i, j in pairwise([0, *full.tolist(), len(rows)]):
                out = []
                for k in range(i, j):
                    if rows[k] != opened:
                        opened = int(rows[k])
                        text = open_.decompress(b["packed"][opened].as_py())
                    out.append(text[lo[k] : hi[k] + length])
                take = pa.array(rows[i:j], pa.int64())
                own = [e.field(k).slice(i, j - i) for k in ("lo", "hi", "at", "core", "known", "crowd")]
                yield pa.RecordBatch.from_arrays(
                    [b["id"].take(take), b["fp"].take(take), *own, pa.array(out, pa.binary())],
                    names=["id", "fp", "lo", "hi", "at", "core", "known", "crowd", "bytes"],
                )

    return run


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Entries in slices whose texts have at most ``SEGMENT`` bytes (an entry is shorter than twice ``length``)."""
    rows = max(1, SEGMENT // (2 * length))
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)


def _places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all starts of entries with ``n`` starts each: entry, and start within the entry."""
    entry = np.repeat(np.arange(len(n)), n)
    return entry, np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)


def _suffixes(b: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all starts of all entries: entry, start within the entry, and a key of (core, place before the trigger, ``length`` bytes)."""
    data, offsets = rolling.utf8(b["bytes"])
    lo, hi, at = (b[k].to_numpy().astype(np.int64) for k in ("lo", "hi", "at"))
    entry, start = _places(hi - lo + 1)
    core = b["core"].to_numpy().view(np.uint64)
    place = rolling.mixed(core[entry] + (at - lo)[entry].astype(np.uint64) - start.astype(np.uint64))
    begin = offsets[:-1][entry] + start
    return entry, start, rolling.mixed(rolling.Rolling(data).pieces(begin, begin + length) ^ place)


def _runs(own: dict[str, np.ndarray], entry: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Repeated starts, sorted, as spans of the documents."""
    new = np.ones(len(entry), bool)
    new[1:] = (entry[1:] != entry[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(entry)) - 1 if len(first) else first
    rows = entry[first]
    lo = own["lo"][rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(own["id"][rows]), pa.array(own["fp"][rows]),
            pa.array((lo + start[first]).astype(np.int32)), pa.array((lo + start[last] + length).astype(np.int32)),
        ],
        names=["id", "fp", "a", "b"],
    )


def _compare(length: int, starts_at_once: int = 1 << 18):
    """Entries sorted by core -> spans of starts that other entries of the core repeat.

    Texts are hashed as they come and not kept: held are a key per start and a few numbers per entry, until their core is complete.
    """

    def agree(own: dict[str, np.ndarray], key: np.ndarray) -> pa.RecordBatch:
        entry, start = _places(own["n"])
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        hit = np.zeros(len(key), bool)
        hit[order[same + 1]] = True
        hit[order[same]] = True
        hit &= ~own["known"][entry]
        return _runs(own, entry[hit], start[hit], length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        keys: list[np.ndarray] = []

        def together() -> tuple[dict[str, np.ndarray], np.ndarray]:
            return {k: np.concatenate([h[k] for h in held]) for k in held[0]}, np.concatenate(keys)

        starts = 0
        for b in _slices(batches, length):
            # copies, since a view would keep the whole batch
            own = {k: np.array(b[k].to_numpy(zero_copy_only=False)) for k in ("id", "fp", "lo", "core", "known")}
            own["n"] = b["hi"].to_numpy().astype(np.int64) - own["lo"] + 1
            held.append(own)
            keys.append(_suffixes(b, length)[2])
            starts += len(keys[-1])
            if starts < starts_at_once or held[0]["core"][0] == own["core"][-1]:
                continue
            own, key = together()
            done = int(np.flatnonzero(own["core"] != own["core"][-1])[-1]) + 1  # all but the last core are complete
            edge = int(own["n"][:done].sum())
            yield agree({k: v[:done] for k, v in own.items()}, key[:edge])
            held, keys, starts = [{k: v[done:].copy() for k, v in own.items()}], [key[edge:].copy()], len(key) - edge
        if held:
            yield agree(*together())

    return run


def _explode(length: int):
    """The same for cores with too many entries: a row for every start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, length):
            entry, start, key = _suffixes(b, length)
            take = pa.array(entry)
            at = b["lo"].to_numpy()[entry] + start
            yield pa.RecordBatch.from_arrays(
                [*[b[k].take(take) for k in ("id", "fp", "core", "known")], pa.array(at.astype(np.int32)), pa.array(key.view(np.int64))],
                names=["id", "fp", "core", "known", "a", "key"],
            )

    return run


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_ = zstandard.ZstdDecompressor()
    for b in batches:
        lists, texts = b["spans"].fill_null([]), b["packed"].to_pylist()
        s = lists.flatten()
        begin, end = s.field("a").to_numpy(), s.field("b").to_numpy()
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        at = 0
        for text, n in zip(texts, lists.value_lengths().to_pylist(), strict=True):
            text = open_.decompress(text)
            size, removed, spans = len(text), 0, 0
            if n:
                order = np.argsort(begin[at : at + n], kind="stable")
                a, z = begin[at : at + n][order], np.maximum.accumulate(end[at : at + n][order])
                new = np.append(True, a[1:] > z[:-1])
                a, z = a[new], z[np.append(np.flatnonzero(new)[1:], n) - 1]
                at, spans, removed = at + n, len(a), int((z - a).sum())
                text = b"".join(text[i:j] for i, j in zip([0, *z.tolist()], [*a.tolist(), size], strict=True))
            for k, v in (("n_bytes", size), ("n_removed", removed), ("n_spans", spans), ("kept", text)):
                out[k].append(v)
        rest = [n for n in b.schema.names if n not in ("packed", "spans")]
        new = [pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")]
        yield pa.RecordBatch.from_arrays([*[b[n] for n in rest], *new, pa.array(out["kept"], pa.binary())], names=[*rest, "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, span: int = 256, most: int = 1_000_000
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept``, the bytes that stay (a cut may fall inside a character), per row of ``docs``.

    Texts count as UTF-8, null as empty; a text shorter than ``length`` stays whole. A repeated row repeats all its strings. Rows are told
    apart by id and text, so a null or repeated id does no harm. Only the two columns are read; no rows give no rows.
    """
    if span + GRAM - 1 > length:
        raise ValueError("a string must hold a whole span of hash places")
    smaller_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63))).alias("id"),
        F.hash(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("fp"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    shape = "id long, fp int, lo int, hi int, at int, core long, whole long"
    parse = scratch(rows.where(F.octet_length("text") >= length).select("id", "fp", "text").mapInArrow(_parse(length, span), shape))

    cores = parse.groupBy("core").agg(F.count("*").alias("n"), (F.min("whole") == F.max("whole")).alias("alike")).where("n > 1")
    again = scratch(parse.join(scratch(cores.select("core", "alike")), "core"))  # a common core is split among tasks
    mixed = again.where("not alike")
    here = F.struct("id", "fp", "lo", "hi", "at")
    entries = scratch(mixed.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(here).alias("here")))
    spans = again.where("alike").select("id", "fp", "lo", "hi").unionByName(
        mixed.join(entries.where("n > 1").select("core", "whole"), ["core", "whole"]).select("id", "fp", "lo", "hi")
    ).select("id", "fp", F.col("lo").alias("a"), (F.col("hi") + length).alias("b"))

    kinds = entries.groupBy("core").agg(F.count("*").alias("kinds"), F.min("n").alias("least"), F.sum(F.col("here.hi") - F.col("here.lo") + 1).alias("starts")).where("kinds > 1 and least = 1")
    asked = scratch(
        entries.join(scratch(kinds.select("core", (F.col("starts") > most).alias("crowd"))), "core")
        .select("here.*", "core", (F.col("n") > 1).alias("known"), "crowd")
        .groupBy("id", "fp")
        .agg(F.collect_list(F.struct("lo", "hi", "at", "core", "known", "crowd")).alias("entries"))
    )
    packed = rows.mapInArrow(_pack, "doc_id " + dict(docs.dtypes)[doc_id] + ", id long, fp int, packed binary")
    cut = "id long, fp int, lo int, hi int, at int, core long, known boolean, crowd boolean, bytes binary"
    own = packed.join(asked, ["id", "fp"]).select("id", "fp", "packed", "entries").mapInArrow(_cut(length), cut)
    shape = "id long, fp int, a int, b int"
    small = own.where("not crowd").repartition("core").sortWithinPartitions("core").mapInArrow(_compare(length), shape)
    found = spans.unionByName(small)
    if not asked.where(F.exists("entries", lambda e: e["crowd"])).isEmpty():
        starts = own.where("crowd").mapInArrow(_explode(length), "id long, fp int, core long, known boolean, a int, key long")
        twice = starts.groupBy("core", "key").agg(F.count("*").alias("n")).where("n > 1").select("core", "key")
        large = starts.where("not known").join(twice, ["core", "key"]).select("id", "fp", "a", (F.col("a") + length).alias("b"))
        found = found.unionByName(large)
    told = found.groupBy("id", "fp").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    return (
        packed.join(told, ["id", "fp"], "left")
        .select("doc_id", "packed", "spans")
        .mapInArrow(_drop, "doc_id " + dict(docs.dtypes)[doc_id] + ", n_bytes long, n_removed long, n_spans long, kept binary")
    )
