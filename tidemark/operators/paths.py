"""Longest paths of many small graphs at once, on the rows of whole runs in a task."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package


def _numbered(values: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each value among the distinct ones in their order, from 1 on, null 0; and these values."""
    coded = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[-1] = np.arange(1, len(order) + 1), 0
    return place[coded.indices.fill_null(len(order)).to_numpy()], coded.dictionary.take(pa.array(order))


def _largest(group: np.ndarray, known: np.ndarray, length: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Of each group the place of the greatest (length, tie), an unknown length least."""
    order = np.lexsort((tie, length, known, group))
    return order[np.append(np.flatnonzero(group[order][1:] != group[order][:-1]), len(order) - 1)] if len(order) else order


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first``, ``first`` + 1, ... of each, ``n`` of them."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def solve(t: pa.Table) -> pa.RecordBatch:
    """Longest paths of whole runs, level by level over all of them at once; a run with a cycle gets none."""
    run, runs = _numbered(t["__run"])
    both, names = _numbered(pa.concat_arrays([*t["__node"].chunks, *t["__child"].chunks]))
    node, child = np.split(run * (len(names) + 1) + both.reshape(2, -1), 2)
    node, child, is_null = node[0], child[0], both[: len(t)] == 0
    cost = t["__cost"].fill_null(0.0).to_numpy()
    known = t["__cost"].is_valid().to_numpy()
    is_edge = t["__is_edge"].to_numpy()

    at = np.flatnonzero(~is_edge)
    at = at[_largest(node[at], known[at], cost[at], at)]  # a row per node, by node
    listed, cost, known = node[at], cost[at], known[at]
    e = np.flatnonzero(is_edge & ~is_null)
    from_ = np.searchsorted(listed, node[e])
    found = from_ < len(listed)
    found[found] = listed[from_[found]] == node[e][found]
    e, from_ = e[found], from_[found]
    every = np.union1d(listed, child[e])
    a, b = np.searchsorted(every, node[e]), np.searchsorted(every, child[e])
    order = np.argsort(b, kind="stable")  # edges by child
    a, b, cost, known = a[order], b[order], cost[from_][order], known[from_][order]
    size = len(every)
    waits, leads = np.bincount(b, minlength=size), np.bincount(a, minlength=size)
    into, by_parent, out_of = np.cumsum(waits) - waits, np.argsort(a, kind="stable"), np.cumsum(leads) - leads

    length, sure, back = np.zeros(size), np.ones(size, bool), np.full(size, -1)
    left, settled = waits.copy(), np.zeros(size, bool)
    front = np.flatnonzero(left == 0)
    while len(front):
        settled[front] = True
        k = _ranges(into[front], waits[front])
        sums, safe = length[a[k]] + cost[k], sure[a[k]] & known[k]
        sums[~safe] = 0.0
        best = _largest(b[k], safe, sums, a[k])
        to = b[k][best]
        length[to], sure[to], back[to] = sums[best], safe[best], a[k][best]
        told = b[by_parent[_ranges(out_of[front], leads[front])]]
        told, times = np.unique(told, return_counts=True)
        left[told] -= times
        front = told[left[told] == 0]

    of = every // (len(names) + 1)
    back[every % (len(names) + 1) == 0] = -1  # null is no key to look up
    cyclic = np.unique(of[~settled])
    ends = np.flatnonzero(settled & (leads == 0) & ~np.isin(of, cyclic))
    ends = ends[_largest(of[ends], sure[ends], length[ends], ends)]
    which, now = np.arange(len(ends)), ends
    steps = [(which, now)]
    while len(now):
        on = back[now] >= 0
        which, now = which[on], back[now[on]]
        steps.append((which, now))
    which, passed = (np.concatenate(x) for x in zip(*steps[::-1], strict=True))
    place = every[passed[np.argsort(which, kind="stable")]] % (len(names) + 1) - 1
    starts = pa.array(np.append(0, np.cumsum(np.bincount(which, minlength=len(ends)))), pa.int32())
    path = pa.ListArray.from_arrays(starts, names.take(pa.array(place, mask=place < 0)))
    whole = pa.concat_arrays([path, pa.nulls(len(cyclic), path.type)])
    whose = runs.take(pa.array(np.append(of[ends], cyclic) - 1))
    far = pa.array(np.append(length[ends], np.zeros(len(cyclic))), mask=np.append(~sure[ends], np.ones(len(cyclic), bool)))
    return pa.RecordBatch.from_arrays([whose, far, whole], names=["__run", "length", "p"])


def whole_runs(rows_at_once: int):
    """Rows sorted by run -> :func:`solve` of some ``rows_at_once`` rows at a time, all of a run together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += len(b)
            if rows < rows_at_once:
                continue
            t = pa.Table.from_batches(held)
            place = t["__run"].combine_chunks().dictionary_encode().indices.to_numpy()
            done = int(np.searchsorted(place, place[-1]))  # the last run may go on
            if done:
                yield solve(t.slice(0, done))
            held, rows = t.slice(done).to_batches(), len(t) - done
        if rows:
            yield solve(pa.Table.from_batches(held))

    return run
