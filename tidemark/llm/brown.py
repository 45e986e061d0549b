"""Language-model scoring with word classes: P(text) = product of P(class | class before) * P(word | class).

Classes come from exchange clustering of the words above a small count, and of the endings that rarer words are grouped by, so every
word has a class that its spelling and the table of clustered words (by hash) tell. Counts of words and of neighbours cover all training text;
both are added up in the workers before they are shuffled. The neighbours of an item are kept together, so a round of the
exchange shuffles nothing: workers get the classes of all items and the counts of class pairs, and give back the moves. A worker knows the counts of ``head`` words; the counts of other words reach a document by a
join on the word, which can have no hot key, as such words are rare. Both the base and the model add 1 to the count of a word, so one sum per
document, of log10(count + 1) over its rare words, completes both scores.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc, scratch, smaller_batches

END = b""  # the token after each text; no word is empty


def split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts one after the other, A-Z lower-cased, and how many each text has; null has none."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text.fill_null("")))
    words, ends = parts.flatten().cast(pa.binary()), np.cumsum(parts.value_lengths().to_numpy())
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), np.diff(np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[ends], prepend=0)


def _chunks(batches: Iterator[pa.RecordBatch], most: int = 1 << 22) -> Iterator[pa.Table]:
    """The rows of all batches, joined or cut so that the texts of a chunk have some ``most`` bytes, or are a single text."""
    held, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.binary_length(b["text"]).fill_null(0).to_numpy().astype(np.int64) + 8)
        begin, before = 0, 0
        while begin < len(b):
            stop = min(int(np.searchsorted(ends, before + most - size)) + 1, len(b))
            held.append(b.slice(begin, stop - begin))
            size += int(ends[stop - 1]) - before
            begin, before = stop, int(ends[stop - 1])
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _with_ends(sizes: np.ndarray, first: int) -> np.ndarray:
    """Which places of a line hold words, when an end follows each text and ``first`` ends stand before the first."""
    words = np.ones(first + sizes.sum() + len(sizes), bool)
    words[:first] = False
    words[first - 1 + np.cumsum(sizes + 1)] = False
    return words


def ending(word: bytes, groups: int) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) % groups


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _chunks(batches):
        found = split(t["text"].combine_chunks())[0].value_counts()
        word, n = pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())]), np.append(found.field("counts").to_numpy(), len(t))
        yield pa.RecordBatch.from_arrays([word, pa.array(n, pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` (UTF-8, A-Z lower-cased; empty for the end of a text) and ``n``, over all rows."""
    smaller_batches(docs.sparkSession)
    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_count, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _hashes(words: list[bytes] | pa.Array) -> np.ndarray:
    if isinstance(words, pa.Array):
        words = words.to_numpy(zero_copy_only=False)  # faster than to_pylist
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Numbers(dict):
    """Numbers words as they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Items:
    """Numbers of what is clustered: 0 the end of a text, then the words whose hashes are in ``common`` (sorted), then endings.

    ``look_up`` takes the distinct words of a chunk of text. ``numbers`` goes word by word and remembers up to ``most`` of them.
    """

    def __init__(self, common: np.ndarray, groups: int, most: int = 150_000):
        self.common, self.groups, self.most = common, groups, most
        self.first_group = 1 + len(common)
        self.size = self.first_group + groups
        self._forget()

    def _forget(self) -> None:
        self.known, self.words, self.item = Numbers(), [], np.zeros(0, np.int64)

    def look_up(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Numbers of many words, none of which is remembered."""
        ends = pc.binary_slice(words, -3).dictionary_encode()
        group = np.array([self.first_group + ending(w, self.groups) if w else 0 for w in ends.dictionary.to_pylist()], np.int64)
        found = group[ends.indices.to_numpy()]
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            found = np.where(self.common[at] == hashes, 1 + at, found)
        return found

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        self.item = np.append(self.item, self.look_up(pa.array(words, pa.binary()), hashes))

    def places(self, line: list[bytes]) -> np.ndarray:
        """The place of each word among the remembered ones."""
        if len(self.known) > self.most:
            self._forget()
        out = np.fromiter(map(self.known.__getitem__, line), np.int64, len(line))
        if len(self.known) > len(self.words):
            new = list(islice(reversed(self.known), len(self.known) - len(self.words)))[::-1]
            self.words += new
            self._learn(new, _hashes(new))
        return out

    def numbers(self, line: list[bytes]) -> np.ndarray:
        at = self.places(line)  # may renew the arrays
        return self.item[at]

    def of(self, word: bytes) -> int:
        return int(self.numbers([word])[0])


@contextlib.contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, scans and Python workers take at most ``rows`` rows at once, as each is a long text or an array of many counts."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, str(rows))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _named(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b["word"].to_pylist()
            found = [pa.array(_hashes(words).view(np.int64)), pa.array([ending(w, groups) for w in words], pa.int32()), b["n"]]
            yield pa.RecordBatch.from_arrays(found, names=["hash", "group", "n"])

    return run


def _pack(item: np.ndarray, other: np.ndarray, n: np.ndarray) -> bytes:
    return item.astype(np.uint32).tobytes() + other.astype(np.uint32).tobytes() + n.astype(np.int64).tobytes()


def _unpack(cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = len(cells) // 16
    item, other = np.frombuffer(cells, np.uint32, 2 * k).astype(np.int64).reshape(2, k)
    return item, other, np.frombuffer(cells, np.int64, k, 8 * k)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of ``n`` of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def _neighbours(sent, groups: int, buckets: int, chunk: int = 500_000):
    """Per bucket of items, counts of (item, item after it) and (item, size + item before it), added up over ``chunk`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, groups)
        size, waiting, held = items.size, [], 0

        def told() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(waiting), return_counts=True)
            a, b = pair // size, pair % size
            item, other, n = np.concatenate([a, b]), np.concatenate([b, size + a]), np.concatenate([n, n])
            bucket = (item % buckets).astype(np.uint16 if buckets < 1 << 16 else np.int64)  # short numbers are sorted by radix
            order = np.argsort(bucket, kind="stable")  # the rows of a bucket are added up, and sorted, where they meet
            bucket, item, other, n = bucket[order], item[order], other[order], n[order]
            ends = np.append(np.searchsorted(bucket, np.arange(buckets)), len(item)).tolist()
            parts = [(k, _pack(item[i:j], other[i:j], n[i:j])) for k, (i, j) in enumerate(zip(ends, ends[1:])) if j > i]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], names=["bucket", "cells"])

        for t in _chunks(batches):
            words, sizes = split(t["text"].combine_chunks())
            coded = words.dictionary_encode()
            own = np.zeros(1 + sizes.sum() + len(sizes), np.int64)  # an end comes before each text, and after it
            own[_with_ends(sizes, 1)] = items.look_up(coded.dictionary, _hashes(coded.dictionary))[coded.indices.to_numpy()]
            waiting.append(own[:-1] * size + own[1:])
            held += len(own)
            if held > chunk:
                yield told()
                waiting, held = [], 0
        if held:
            yield told()

    return run


SHARES = 8


def share_of(item: np.ndarray) -> np.ndarray:
    """The turn in which an item moves."""
    return ((item * 0x9E3779B1 & 0xFFFFFFFF) >> 12) % SHARES


def _merge(most: int = 1_000_000, cells_at_once: int = 16_384):
    """Rows sorted by bucket -> rows with all neighbours of some items each, of 256 KB unless one item has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, held = None, [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            return _added(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))

        def told() -> Iterator[pa.RecordBatch]:
            keys, n = added()
            part = share_of(keys >> 32).astype(np.uint8)
            order = np.argsort(part, kind="stable")  # of each share, then by item
            keys, n, part = keys[order], n[order], part[order]
            item, other = keys >> 32, keys & 0xFFFFFFFF
            new = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
            cuts = [new[np.unique(np.searchsorted(new, np.arange(cells_at_once, len(keys), cells_at_once), side="right") - 1)], np.searchsorted(part, np.arange(1, SHARES))]
            ends = np.unique(np.concatenate([*cuts, [len(keys)]])).tolist()
            for i, j in zip([0, *ends], ends):
                if j > i:
                    found = [pa.array([int(part[i])], pa.int32()), pa.array([_pack(item[i:j], other[i:j], n[i:j])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(found, names=["share", "cells"])

        for b in batches:
            for k, cells in zip(b["bucket"].to_pylist(), b["cells"].to_pylist(), strict=True):
                if k != bucket and parts:
                    yield from told()
                    parts, held = [], 0
                bucket = k
                item, other, n = _unpack(cells)
                parts.append((item << 32 | other, n))
                held += len(n)
                if held > most + 2 * len(parts[0][0]):
                    parts = [added()]
                    held = 0
        if parts:
            yield from told()

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, rounds: int = 8) -> np.ndarray:
    """Class of each item, from the counts of neighbouring items; the end of a text (item 0) is class 0 alone.

    Items start dealt out by frequency; then each in turn moves to the class where the likelihood of the class bigrams is greatest, until
    none moves or ``rounds`` are over.
    """
    n = len(pairs)
    total = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = [i for i in np.argsort(-total, kind="stable").tolist() if i and total[i] > 0]
    own = np.ones(n, np.int64)
    own[0] = 0
    for k, i in enumerate(order):
        own[i] = 1 + k % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), own] = 1
    right, left = pairs @ member, pairs.T @ member  # of each item: to classes after it, from classes before it
    between = member.T @ right
    each = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for i in order:
            old, loop = own[i], pairs[i, i]
            r, c = right[i].copy(), left[i].copy()
            r[old] -= loop
            c[old] -= loop
            between[old] -= r
            between[:, old] -= c
            between[old, old] -= loop
            with_row, with_col = between + r, between + c[:, None]
            gain = (_xlogx(with_row) - _xlogx(between)).sum(axis=1) + (_xlogx(with_col) - _xlogx(between)).sum(axis=0)
            diagonal, both = between[each, each], r + c + loop
            gain += _xlogx(diagonal + both) + _xlogx(diagonal) - _xlogx(diagonal + r) - _xlogx(diagonal + c)
            out, come = between.sum(axis=1) + c, between.sum(axis=0) + r  # with the item, wherever it goes
            gain -= _xlogx(out + r.sum() + loop) - _xlogx(out) + _xlogx(come + c.sum() + loop) - _xlogx(come)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            between[new] += r
            between[:, new] += c
            between[new, new] += loop
            if new != old:
                moved += 1
                own[i] = new
                right[:, old] -= pairs[:, i]
                right[:, new] += pairs[:, i]
                left[:, old] -= pairs[i]
                left[:, new] += pairs[i]
        if not moved:
            break
    return own


def _seeds(sent, first: int):
    """Counts of neighbouring seeds: items as ``fold`` names them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = sent.value
        size = len(fold)
        pairs = np.zeros(first**2, np.int64)
        for b in batches:
            for cells in b["cells"].to_pylist():
                item, other, n = _unpack(cells)
                after = other < size
                pairs += np.bincount(fold[item[after]] * first + fold[other[after]], n[after], len(pairs)).astype(np.int64)
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(pairs[at])], names=["pair", "n"])

    return run


def _cluster(size: int, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(size**2)
        for b in batches:
            pairs[b["pair"].to_numpy()] += b["n"].to_numpy()
        own = exchange(pairs.reshape(size, size), classes)
        yield pa.RecordBatch.from_arrays([pa.array([own.tolist()])], names=["own"])

    return run


def _of_class(values: np.ndarray, other: np.ndarray, table: np.ndarray, old: np.ndarray, both: np.ndarray) -> np.ndarray:
    """For each item and class k: by how much the sum of x log x over row k of ``table`` rises when the item's ``values`` are added to it.

    Before that the item is taken out of row and column ``old``: there go ``values`` and ``other``, and the cell of both is ``both``.
    """
    item, j = np.nonzero(values)
    gain = np.zeros(values.shape)
    if not len(item):
        return gain
    v, own = values[item, j], old[item]
    cells, low = table.T[j], _xlogx(table).T[j]  # of column j, one row per entry, by class
    e = np.arange(len(item))
    cells[e, own] -= v
    low[e, own] = _xlogx(cells[e, own])
    at = np.flatnonzero(j == own)
    cells[at] -= other[item[at]]
    cells[at, own[at]] = both[item[at]]
    low[at] = _xlogx(cells[at])
    first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
    gain[item[first]] = np.add.reduceat(_xlogx(cells + v[:, None]) - low, first, axis=0)
    return gain


def best_class(between: np.ndarray, old: np.ndarray, r: np.ndarray, c: np.ndarray, loop: np.ndarray) -> np.ndarray:
    """The step of :func:`exchange` for many items at once, each as if it alone moved: the class of each that suits it best.

    ``r`` and ``c`` are its counts to classes after it and from classes before it, ``loop`` those of the item after itself. The work follows
    the cells of ``r`` and ``c`` that aren't 0, which are few for a rare word.
    """
    k, each = np.arange(len(old)), np.arange(len(between))
    r, c = r.copy(), c.copy()
    r[k, old] -= loop
    c[k, old] -= loop
    both = between[old, old] - r[k, old] - c[k, old] - loop
    gain = _of_class(r, c, between, old, both) + _of_class(c, r, between.T, old, both)
    diagonal = np.repeat(between[each, each][None], len(old), axis=0)
    diagonal[k, old] = both
    touched = (r != 0) | (c != 0) | (loop != 0)[:, None]
    d, x, y, z = diagonal[touched], r[touched], c[touched], np.repeat(loop[:, None], len(each), axis=1)[touched]
    gain[touched] += _xlogx(d + x + y + z) + _xlogx(d) - _xlogx(d + x) - _xlogx(d + y)
    for side, own in ((between.sum(axis=1), r), (between.sum(axis=0), c)):  # with the item, wherever it goes
        whole = own.sum(axis=1) + loop
        side = np.repeat(side[None], len(old), axis=0)
        side[k, old] -= whole
        gain -= _xlogx(side + whole[:, None]) - _xlogx(side)
    gain[:, 0] = -np.inf
    new = gain.argmax(axis=1)
    return np.where(gain[k, new] > gain[k, old] + 1e-9, new, old)


def _totals(sent, classes: int):
    """Counts of class pairs over all cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = sent.value, np.zeros(classes**2)
        for b in batches:
            for cells in b["cells"].to_pylist():
                item, other, n = _unpack(cells)
                after = other < len(own)
                sums += np.bincount(own[item[after]].astype(np.int64) * classes + own[other[after]], n[after], classes**2)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    return run


def _turn(sent, classes: int, at_once: int = 128):
    """Of the items that were moved, what it changed in the counts of class pairs; of those next in turn, which another class suits better, and this class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trial, between, asked = sent.value
        size, change, found = len(own), np.zeros(classes**2), [np.zeros((2, 0), np.int64)]
        for b in batches:
            for share in np.unique(b["share"].to_numpy()).tolist():
                mask = pa.array(b["share"].to_numpy() == share)
                item, other, n = (np.concatenate(x) for x in zip(*[_unpack(c) for c in b["cells"].filter(mask).to_pylist()], strict=True))  # an item is in one row
                after = other < size
                near = np.where(after, other, other - size)
                if share != asked:
                    # a pair of two moved items counts once, as what comes after the first
                    moved = (trial[item] != own[item]) & (after | (trial[near] == own[near]))
                    item, near, n, after = item[moved], near[moved], n[moved], after[moved]
                    first, second = np.where(after, item, near), np.where(after, near, item)
                    for kind, sign in ((own, -1.0), (trial, 1.0)):
                        change += sign * np.bincount(kind[first].astype(np.int64) * classes + kind[second], n, classes**2)
                    continue
                ours = item > 0
                item, near, other, n, after = item[ours], near[ours], other[ours], n[ours], after[ours]
                if not len(item):
                    continue
                first = np.append(True, item[1:] != item[:-1])
                at, row = item[first], np.cumsum(first) - 1
                both = np.bincount((row * 2 + ~after) * classes + trial[near], n, len(at) * 2 * classes).reshape(len(at), 2, classes)
                loop = np.bincount(row, n * (other == item), len(at))
                old = trial[at].astype(np.int64)
                new = [best_class(between, *(x[i : i + at_once] for x in (old, both[:, 0], both[:, 1], loop))) for i in range(0, len(at), at_once)]
                new = np.concatenate(new)
                found.append(np.stack([at, new])[:, new != old])
        yield pa.RecordBatch.from_arrays([pa.array([change.tobytes()], pa.binary()), pa.array([np.concatenate(found, axis=1).tobytes()], pa.binary())], names=["change", "moves"])

    return run


def _likelihood(between: np.ndarray) -> float:
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=0)).sum() - _xlogx(between.sum(axis=1)).sum())


def exchange_all(cells: DataFrame, own: np.ndarray, classes: int, few: float = 2e-2) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all items and the counts of neighbouring classes, from the classes ``own`` on.

    In a turn, one share of the items moves, all at once, each to the class that suits it best. One job reads two shares: it counts what these moves
    change in the class pairs, and asks the items next in turn already, by the counts from before. If the moves didn't raise the
    likelihood, half of them are made, and so on. It ends when a round of all shares raises it by less than ``few`` nats per token.
    """
    spark, draw = cells.sparkSession, np.random.default_rng(1)

    def told(rows: DataFrame, run, names: str, *sent) -> list:
        value = spark.sparkContext.broadcast(sent if len(sent) > 1 else sent[0])
        found = rows.mapInArrow(run(value, classes), ", ".join(f"{n} binary" for n in names.split())).collect()
        value.unpersist()
        return found

    def asked(own: np.ndarray, trial: np.ndarray, between: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts after the moves of the turn before, and moves of this turn."""
        shares = [turn % SHARES] if trial is own else [turn % SHARES, (turn - 1) % SHARES]
        rows = told(cells.where(F.col("share").isin(shares)).select("share", "cells"), _turn, "change moves", own, trial, between, turn % SHARES)
        change = sum((np.frombuffer(r.change) for r in rows), np.zeros(classes**2))
        moves = np.concatenate([np.zeros((2, 0), np.int64), *[np.frombuffer(r.moves, np.int64).reshape(2, -1) for r in rows]], axis=1)
        return between + change.reshape(classes, classes), moves[:, draw.permutation(np.argsort(moves[0]))]

    own = own.astype(np.int16)
    sums = (np.frombuffer(r.sums) for r in told(cells.select("cells"), _totals, "sums", own))
    between = sum(sums, np.zeros(classes**2)).reshape(classes, classes)
    best, turn, seen = _likelihood(between), 0, []
    _, moves = asked(own, own, between, turn)
    while True:
        if moves.shape[1]:
            trial = own.copy()
            trial[moves[0]] = moves[1]
            table, next_moves = asked(own, trial, between, turn + 1)
            if (now := _likelihood(table)) <= best:
                moves = moves[:, : moves.shape[1] // 2]
                if moves.shape[1]:
                    continue
                now, next_moves = best, asked(own, own, between, turn + 1)[1]
            else:
                own, between = trial, table
        else:
            now, next_moves = best, asked(own, own, between, turn + 1)[1]
        seen.append(now - best)
        best, moves, turn = now, next_moves, turn + 1
        if turn % SHARES == 0 and sum(seen[-SHARES:]) <= few * between.sum():
            return own, between


def _classed(sent, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, own = sent.value
        items = Items(common, groups)
        for b in batches:
            found = own[items.look_up(b["word"], _hashes(b["word"]))].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), b["n"]], names=["class", "n"])

    return run


@dataclass
class Model:
    """``counts`` (word, n) is a table of all words; ``common`` and ``own`` have some 10 bytes per clustered word; all else is bounded by the parameters."""

    counts: DataFrame
    tokens: int
    types: int
    common: np.ndarray  # sorted hashes of the words clustered one by one
    groups: int
    own: np.ndarray  # class of each item
    step: np.ndarray  # log10 P(class | class before)
    spread: np.ndarray  # by class, log10 of what the count + 1 of a word is divided by
    head: tuple[np.ndarray, np.ndarray]  # hashes (sorted) and counts of the words sent to workers


def _down_to(levels: list, room: int) -> int:
    """The least level that ``room`` words reach, counted from the highest level down; all words of a level together."""
    least = 1 << 30
    for level, n in levels:
        room -= n
        if room < 0:
            break
        least = level
    return least


def fit(
    docs: DataFrame, text: str = "text", head: int = 200_000, clustered: int = 800, groups: int = 128, classes: int = 48, often: int = 10, most: int = 500_000
) -> Model:
    """Model of all rows of ``docs``. ``head`` bounds the words sent to workers with their counts, ``most`` those with a class of their own.

    Of the words that occur ``often`` times, the ``most`` commonest have a class of their own choice: the driver and each worker hold some 10 bytes
    for each. The ``clustered`` commonest and the endings are moved one after the other first; then all of them, starting from the classes of their
    endings, in parallel (:func:`exchange_all`). All other words have the class of their ending.
    Both bounds take words from the highest counts down, all words of about the same count together (a 64th of an octave).
    """
    docs = docs.select(F.col(f"`{text}`").alias("text"))
    counts = scratch(word_counts(docs))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("types")).first()
    level = F.floor(F.log2("n") * 64)
    levels = sorted(((r.level, r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)  # 64 an octave
    top = counts.where(level >= _down_to(levels, head)).mapInArrow(_named(groups), "hash long, group int, n long").toArrow()
    known = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(known)
    spark = docs.sparkSession
    frequent = (level >= _down_to(levels, most)) & (F.col("n") >= often) & (F.length("word") > 0)
    named = counts.where(frequent).mapInArrow(_named(groups), "hash long, group int, n long").toArrow()
    common, at = np.unique(named["hash"].to_numpy().view(np.uint64), return_index=True)
    seeds = np.lexsort((common, -named["n"].to_numpy()[at]))[:clustered]
    first = 1 + len(seeds) + groups
    fold = np.concatenate([[0], 1 + len(seeds) + named["group"].to_numpy()[at], 1 + len(seeds) + np.arange(groups)])
    fold[1 + seeds] = 1 + np.arange(len(seeds))

    told = spark.sparkContext.broadcast(common)
    buckets = max(256, int(total.n or 0) >> 21)
    with _batches(spark, 64):
        parts = docs.mapInArrow(_neighbours(told, groups, buckets), "bucket int, cells binary")
        cells = scratch(parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(), "share int, cells binary"), by=("share",))
    with _batches(spark, 16):
        folded = scratch(cells.mapInArrow(_seeds(spark.sparkContext.broadcast(fold), first), "pair long, n long"))
    pairs = folded.groupBy("pair").agg(F.sum("n").alias("n"))
    found = pairs.repartition(1).mapInArrow(_cluster(first, classes), "own array<bigint>").first()
    with _batches(spark, 16):
        own, between = exchange_all(cells, np.array(found.own)[fold] if found else np.minimum(fold, 1), classes)
    between = between + 0.1
    spread = np.full(classes, np.log10(2.0))
    told = spark.sparkContext.broadcast((common, own))
    for r in counts.mapInArrow(_classed(told, groups), "class long, n long").groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        spread[r["class"]] = np.log10(r.n + r.types + 1)
    step = np.log10(between / between.sum(axis=1, keepdims=True))
    return Model(counts, int(total.n or 0), int(total.types), common, groups, own, step, spread, (known[order], top["n"].to_numpy()[order]))


def _score(sent, base: float):
    """Per text a row with its sums, and a row per distinct word that isn't in the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, groups, own, step, spread, head, counts = sent.value
        items = Items(common, groups)
        for t in _chunks(batches):
            words, sizes = split(t["text"].combine_chunks())
            coded = words.dictionary_encode()
            known_words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
            hashes, size, n = _hashes(known_words), sizes + 1, len(t)
            in_head, log = np.zeros(len(hashes), bool), np.zeros(len(hashes))
            if len(head):
                place = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
                in_head = head[place] == hashes
                log = np.where(in_head, np.log10(counts[place] + 1.0), 0.0)
            at = np.full(size.sum(), len(coded.dictionary))
            at[_with_ends(sizes, 0)] = coded.indices.to_numpy()
            first = np.cumsum(size) - size
            kind, known = own[items.look_up(known_words, hashes)].astype(np.int64)[at], in_head[at]
            walk = step[np.append(0, kind[:-1]), kind] - spread[kind]  # an end comes before each text
            sums = [np.add.reduceat(x, first) for x in (known.astype(np.int64), log[at], walk)]
            rare = np.flatnonzero(~known)
            cell, m = np.unique(np.repeat(np.arange(n), size)[rare] * len(hashes) + at[rare], return_counts=True)
            text, word = cell // len(hashes), known_words.take(pa.array(cell % len(hashes)))
            row, ids = t["row"].to_numpy(), t["doc_id"].combine_chunks()
            whole = lambda x, t: pa.concat_arrays([pa.array(x, t), pa.nulls(len(word), t)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(row, row[text])), pa.concat_arrays([pa.nulls(n, pa.binary()), word]),
                    pa.array(np.append(size, m)), whole(sums[0], pa.int64()), whole(sums[1], pa.float64()), whole(sums[2], pa.float64()),
                    whole(-base * size, pa.float64()), pa.concat_arrays([ids, pa.nulls(len(word), ids.type)]),
                ],
                names=["row", "word", "m", "known", "part", "score", "base_score", "doc_id"],
            )

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity``. Scores are sums of log10.

    A text is its words and one end; null and empty texts are the end alone. Repeated rows are scored alike; no rows give no rows. A
    model of no text knows no word.
    """
    spark = docs.sparkSession
    smaller_batches(spark)
    base = float(np.log10(model.tokens + model.types + 1))
    sent = spark.sparkContext.broadcast((model.common, model.groups, model.own, model.step, model.spread, *model.head))
    kind = docs.select(F.col(f"`{doc_id}`")).dtypes[0][1]
    at = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text"))

    shape = f"row long, word binary, m long, known long, part double, score double, base_score double, doc_id {kind}"
    told = scratch(at.mapInArrow(_score(sent, base), shape))
    rare = told.where("word is not null").select("row", "word", "m").join(model.counts, "word", "left")
    rare = rare.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("seen")
    )
    part = F.col("part") + F.coalesce("more", F.lit(0.0))
    out = told.where("word is null").join(rare, F.col("row") == F.col("_row"), "left")
    out = out.select(
        "doc_id", F.col("m").alias("n_tokens"), (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (part + F.col("base_score")).alias("base_score"), (part + F.col("score")).alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    """Rows whose crc32 of the id as text leaves ``part``; a null id counts as the empty text."""
    return F.pmod(crc(doc_id), F.lit(parts)) == part
