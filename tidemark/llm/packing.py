"""Counting of terms in many texts at once, for Python workers (numpy, no Spark).

Terms are kept apart by length. Up to 8 bytes fill one uint64, up to 16 two, highest byte first, and are sorted by 16-bit digits from the
lowest, each pass a radix sort of uint16; a bucket holds the terms with equally many digits, so no pass is spent on padding. Longer terms are gathered
into byte strings of a fixed width, a bucket for each power of two, and sorted as bytes. Sorted equal terms are runs, and a
run's length is the count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORD, WIDE = 8, 16


def letters() -> np.ndarray:
    """Byte -> itself for a-z and all above 0x7F, lower case for A-Z, 0 (ends a term) for the rest."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[0x61:0x7B] = table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


LETTERS = letters()


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with A-Z lowered and all else but letters 0 (16 zeros appended); start and length of every term, and its text."""
    low = np.zeros(len(data) + WIDE, np.uint8)
    low[: len(data)] = LETTERS[data]
    inside = low[: len(data)] != 0
    edges = offsets[offsets < len(data)]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[edges] = inside[edges]
    closes[:-1] &= ~inside[1:]
    ends = edges[edges > 0] - 1
    closes[ends] = inside[ends]
    start = np.flatnonzero(opens)
    return low, start, np.flatnonzero(closes) + 1 - start, np.searchsorted(offsets, start, side="right") - 1


def radix_order(order: np.ndarray, words: list[np.ndarray], digits: int) -> np.ndarray:
    """``order`` sorted stably by the first ``digits`` 16-bit digits of ``words``, of which the first is the highest."""
    for d in reversed(range(digits)):
        word, shift = words[d // 4], np.uint64(48 - 16 * (d % 4))
        digit = (word[order] >> shift).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]
    return order


def packed(low: np.ndarray, start: np.ndarray, length: np.ndarray, n: int) -> list[np.ndarray]:
    """Terms of at most 8 ``n`` bytes as ``n`` uint64 each, highest byte first, zeros behind."""
    every = np.ndarray((len(low) - WORD + 1,), ">u8", low, strides=(1,))
    out = []
    for k in range(n):
        word = every[start + WORD * k].astype(np.uint64)
        spare = (WORD * (k + 1) - np.clip(length, WORD * k, WORD * (k + 1))).astype(np.uint64) * np.uint64(8)
        gone = spare >= 64
        spare = np.where(gone, np.uint64(0), spare)
        out.append(np.where(gone, np.uint64(0), word >> spare << spare))
    return out


def _gathered(low: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(width)
    take = np.minimum(start[:, None] + at, len(low) - 1)
    return np.where(at < length[:, None], low[take], 0).astype(np.uint8).view(f"S{width}").ravel()


def buckets(low: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per bucket of lengths: its terms (as indices) in an order that brings equal ones together and else keeps them, and where a new term begins."""
    digits = (length + 1) // 2
    for d in np.unique(digits[length <= WIDE]).tolist():
        own = np.flatnonzero(digits == d)
        words = packed(low, start[own], length[own], 1 + (2 * d > WORD))
        order = radix_order(np.arange(len(own)), words, d)
        new = np.ones(len(own), bool)
        new[1:] = np.logical_or.reduce([w[order][1:] != w[order][:-1] for w in words])
        yield own[order], new
    long = np.flatnonzero(length > WIDE)
    width = 1 << np.ceil(np.log2(np.maximum(length[long], 1))).astype(np.int64)
    for w in np.unique(width).tolist():
        own = long[width == w]
        text = _gathered(low, start[own], length[own], w)
        order = np.argsort(text, kind="stable")
        text = text[order]
        new = np.ones(len(own), bool)
        new[1:] = text[1:] != text[:-1]
        yield own[order], new


def counted(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Per bucket: distinct (term, group of its text), as terms and groups, with the number of occurrences and of texts that have it."""
    low, start, length, text = terms(data, offsets)
    if not len(start):
        return
    own_group = group[text]
    if len(group) and group.max() > 0:  # terms of a group together, texts still in their order
        order = np.argsort(own_group.astype(np.uint16) if group.max() < 1 << 16 else own_group, kind="stable")
        start, length, text, own_group = start[order], length[order], text[order], own_group[order]
    whole = low.tobytes()
    for order, new in buckets(low, start, length):
        of_group, of_text = own_group[order], text[order]
        cell = new.copy()
        cell[1:] |= of_group[1:] != of_group[:-1]
        first_in_text = cell.copy()
        first_in_text[1:] |= of_text[1:] != of_text[:-1]
        first = np.flatnonzero(cell)
        n = np.diff(np.append(first, len(order)))
        n_texts = np.add.reduceat(first_in_text.astype(np.int64), first)
        at = order[first]
        found = [whole[a:z] for a, z in zip(start[at].tolist(), (start[at] + length[at]).tolist(), strict=True)]
        yield found, of_group[first], n, n_texts
