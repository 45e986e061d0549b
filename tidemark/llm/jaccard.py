"""Similarity join of texts by the Jaccard coefficient of their shingles, with a chosen-path join.

Texts become sets of hashed shingles; texts with equal sets are copies and one node from then on. Each node samples ``SAMPLES`` of its tokens, one
under each of as many random orders (a node's least token under an order is shared by two sets as often as they are similar).
A run of the join puts nodes that share the sampled token of one order into a bucket; a bucket with more than ``bucket`` nodes is split again by
a token under another order, chosen by the path so far. Small buckets are compared by brute force on the samples. A pair as similar as
``threshold`` stays together over d splits with chance ``threshold ** d``, so runs are repeated until ``recall`` is reached for the deepest path.
What a bucket finds alike is a candidate group. Groups are then compared exactly, all members with all, on whole sets; links and
classes come from that alone.

No list of pairs is ever made: a bucket returns a tree over what it found alike, a group returns for each node the number of its links and
a tree. A bucket or group too large for a task is cut into blocks, and each pair of blocks is one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.common import WHITE_BYTES, fresh, scratch, smaller_batches
from tidemark.llm.groups import components, forest, whole_groups

SAMPLES = 64
BLANK = np.zeros(256, bool)
BLANK[list(WHITE_BYTES)] = True
#: Seeds of the orders, drawn once.
_draw = np.random.default_rng(11)
FLIPS = _draw.integers(0, 2**32, SAMPLES, dtype=np.uint32)
FACTORS = _draw.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word of many texts, and the number of words before each text (n + 1 values)."""
    inside = ~BLANK[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    before = np.append(False, inside[:-1]) if len(inside) else inside
    after = np.append(inside[1:], False) if len(inside) else inside
    first = np.flatnonzero(inside & (~before | begins[:-1]))
    end = np.flatnonzero(inside & (~after | begins[1:])) + 1
    return first, end, np.searchsorted(first, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``size`` successive words per text; a shorter text with a word has one of all its words."""
    first, end, count = word_spans(data, offsets)
    h = rolling.Rolling(data).pieces(first, end)
    n = len(h)
    total = np.zeros(n, np.uint64)
    weights = rolling.powers(size, rolling.BASE)
    for k in range(min(size, n)):
        total[: n - k] += h[k:] * weights[k]
    total = rolling.mixed(total)
    out = []
    for i in range(len(offsets) - 1):
        a, b = count[i], count[i + 1]
        if b - a >= size:
            out.append(np.unique(total[a : b - size + 1]))
        elif b > a:
            out.append(rolling.mixed((h[a:b] * weights[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(h[:0])
    return out


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, the least value under each order; sets must not be empty."""
    tokens = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    return np.stack([np.minimum.reduceat((tokens ^ f) * m, starts) for f, m in zip(FLIPS, FACTORS, strict=True)], axis=1)


def node_of(tokens: np.ndarray) -> int:
    """One number for a set of tokens."""
    return int(rolling.mixed(np.bitwise_xor.reduce(rolling.mixed(tokens + np.uint64(77)), keepdims=True) + tokens.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*rolling.utf8(b["text"]), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            values = samples([sets[i] for i in full]).view(np.int32) if full else np.zeros((0, SAMPLES), np.int32)
            nodes, signs = [None] * len(sets), [None] * len(sets)
            for k, i in enumerate(full):
                nodes[i], signs[i] = node_of(sets[i]), values[k]
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[b[n] for n in rest], pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(signs, pa.list_(pa.int32()))],
                names=[*rest, "node", "n_shingles", "sample"],
            )

    return run


def _sets(size: int):
    """Texts of nodes -> their sets, once for each pair of blocks they take part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(*rolling.utf8(b["text"]), size)
            same = [len(s) > 0 and node_of(s) == n for s, n in zip(sets, b["node"].to_pylist(), strict=True)]
            kept = pa.array(np.flatnonzero(same), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[b[n].take(kept) for n in ("node", "copies", "root", "blocks")], pa.array([s.tobytes() for s, ok in zip(sets, same, strict=True) if ok], pa.binary())],
                names=["node", "copies", "root", "blocks", "tokens"],
            )

    return run


def _spread(node: str, blocks: Column) -> list[Column]:
    """The block of a row, and all pairs of blocks (i, j) that it takes part in, to be exploded."""
    own = F.pmod(F.xxhash64(node, F.lit(3)), blocks.cast("long"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1), lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    return [own.alias("block"), F.explode(pairs).alias("pair")]


def _in_groups(df: DataFrame, key: str, node: str, blocks: str) -> DataFrame:
    """Rows dealt out by (key, pair of blocks) as column ``task``, sorted so that a task's rows follow each other."""
    kept = [c for c in df.columns if c not in (key, blocks)]
    spread = df.select(*kept, F.col(key), *_spread(node, F.col(blocks)))
    spread = spread.select(*kept, F.xxhash64(key, "pair.i", "pair.j").alias("task"), (F.col("pair.i") != F.col("pair.j")).alias("cross"), "block")
    return spread.repartition("task").sortWithinPartitions("task", "block", node)


def _alike(least: float):
    """Buckets -> for each node found alike with others, the first node of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "task"):
            task, node, block = (t[k].to_numpy() for k in ("task", "node", "block"))
            cross = t["cross"].to_numpy(zero_copy_only=False)
            sample = t["sample"].combine_chunks().flatten().to_numpy().reshape(-1, SAMPLES)
            found_a, found_b = [], []
            rows, shift = np.arange(len(task)), 1
            while True:
                rows = rows[rows + shift < len(task)]
                rows = rows[task[rows] == task[rows + shift]]
                if not len(rows):
                    break
                pick = rows[~cross[rows] | (block[rows] != block[rows + shift])]
                for part in np.array_split(pick, len(pick) // 65536 + 1):
                    share = (sample[part] == sample[part + shift]).sum(axis=1)
                    hit = part[share >= least * SAMPLES]
                    found_a.append(hit)
                    found_b.append(hit + shift)
                shift += 1
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))
            root = forest(len(task), a, b)
            tree = np.flatnonzero(root != np.arange(len(task)))
            yield pa.RecordBatch.from_arrays([pa.array(node[tree]), pa.array(node[root[tree]])], names=["a", "b"])

    return run


def _links(threshold: float, columns: int = 4096):
    """Candidate groups -> for each node the texts it is linked to within this task, and the first node of its tree."""

    def within(node: np.ndarray, copies: np.ndarray, block: np.ndarray, cross: bool, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), sizes)
        _, token, often = np.unique(tokens, return_inverse=True, return_counts=True)
        shared = often[token] > 1
        renumber = np.cumsum(often > 1) - 1
        row, token = row[shared], renumber[token[shared]]
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        common = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, int((often > 1).sum()), columns):
            lo, hi = np.searchsorted(token, (at, at + columns))
            table = np.zeros((len(sets), columns), np.float32)
            table[row[lo:hi], token[lo:hi] - at] = 1
            common += table @ table.T
        both = sizes[:, None] + sizes[None, :] - common.astype(np.int64)
        linked = common.astype(np.float64) / both >= threshold
        np.fill_diagonal(linked, False)
        if cross:
            linked &= block[:, None] != block[None, :]
        root = forest(len(sets), *np.nonzero(np.triu(linked)))
        return linked @ copies, node[root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "task", 1024):
            task, node, copies, block = (t[k].to_numpy() for k in ("task", "node", "copies", "block"))
            cross = t["cross"].to_numpy(zero_copy_only=False)
            sets = [np.frombuffer(x, np.uint64) for x in t["tokens"].to_pylist()]
            edges = np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), len(task))
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                keep = lo + np.unique(node[lo:hi], return_index=True)[1]  # a repeated row of documents gives a node twice
                links, root = within(node[keep], copies[keep], block[keep], bool(cross[lo]), [sets[i] for i in keep])
                out.append((node[keep], links.astype(np.int64), root))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["node", "links", "root"])

    return run


def chosen_paths(nodes: DataFrame, runs: int, depth: int, bucket: int) -> DataFrame:
    """``node, sample`` -> ``node, path, size``: the buckets of two nodes or more that remain after splitting, each set of nodes once."""
    deal = lambda path: F.pmod(path, F.lit(SAMPLES)).cast("int")
    split = lambda path, sample: F.xxhash64(path, F.get(sample, deal(path)))
    run = F.explode(F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda r: F.xxhash64(F.lit(5), r)))
    at = nodes.select("node", "sample", run.alias("path")).select("node", split(F.col("path"), F.col("sample")).alias("path"))
    done = None
    for level in range(1, depth + 1):
        at = scratch(at)
        sizes = at.groupBy("path").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("content")).where("size > 1")
        sizes = scratch(sizes)
        once = scratch(sizes.groupBy("size", "content").agg(F.min("path").alias("path")))
        small = at.join(once.where((F.col("size") <= bucket) | F.lit(level == depth)).select("path", "size"), "path").select("node", "path", "size")
        done = small if done is None else done.unionByName(small)
        large = once.where(F.col("size") > bucket)
        if level == depth or large.isEmpty():
            return done
        # paths that led to one set of nodes go on apart: other paths, other tokens
        large = at.join(sizes.where(F.col("size") > bucket).select("path"), "path")
        at = large.join(nodes.select("node", "sample"), "node").select("node", split(F.col("path"), F.col("sample")).alias("path"))
    return done


def similar(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.995,
    depth: int = 3,
    bucket: int = 1024,
    slack: float = 0.3,
    sent: int = 500_000,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``class_id``, ``n_links``, ``n_copies``, ``n_shingles``, ``first`` (this row stands for its class).

    Words are ``[^\\x20\\x09-\\x0D]+``, a shingle is ``size`` of them; a shorter text with a word has one shingle of all. Two rows are linked
    when their sets have a Jaccard coefficient of ``threshold`` or more; ``n_links`` counts all other rows linked to this one, copies included,
    ``n_copies`` the rows with the same set, itself included. A class is what links connect, named by its least id (a null id counts as the least and
    names it null). A text without words (null, empty) is linked to nothing and a class of its own, with no copies but itself. Repeated rows are
    copies. Extra columns are ignored; no rows give no rows. A bucket misses a pair when fewer than ``threshold - slack`` of its samples agree
    (at 0.8, twice in 100 million pairs). All runs compare the same samples, so only the rest of the group makes up for it. Up to ``sent`` rows of candidate groups (48 bytes
    each) are broadcast to find their texts.
    """
    smaller_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63))).alias("id"),
        F.hash(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("fp"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    told = scratch(rows.mapInArrow(_sketch(size), f"doc_id {kind}, id long, fp int, node long, n_shingles long, sample array<int>"))
    nodes = scratch(
        told.where("node is not null").groupBy("node")
        .agg(F.count("*").alias("copies"), F.min(F.struct("id", "fp")).alias("here"), F.first("sample").alias("sample"))
    )

    runs = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))
    buckets = scratch(chosen_paths(nodes, runs, depth, bucket))
    held = buckets.join(nodes.select("node", "sample"), "node")
    held = held.withColumn("blocks", F.ceil(F.col("size") / bucket)).drop("size")
    edges = _in_groups(held, "path", "node", "blocks").mapInArrow(_alike(threshold - slack), "a long, b long")
    candidates = components(edges)

    members = candidates.unionByName(candidates.select(F.col("root").alias("node"), "root").distinct())
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / bucket).alias("blocks"))
    asked = scratch(members.join(sizes, "root").join(nodes.select("node", "copies", "here.*"), "node"))
    few = asked.count() <= sent  # then texts stay where they are; else they are shuffled to the rows that ask for them
    texts = rows.select("id", "fp", "text").join(F.broadcast(asked) if few else asked, ["id", "fp"]).select("text", "node", "copies", "root", "blocks")
    sets = texts.mapInArrow(_sets(size), "node long, copies long, root long, blocks long, tokens binary")
    linked = scratch(_in_groups(sets, "root", "node", "blocks").mapInArrow(_links(threshold), "node long, links long, root long"))
    degree = linked.groupBy("node").agg(F.sum("links").alias("links")).where("links > 0")
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))

    classes = nodes.join(degree, "node", "left").join(roots, "node", "left").select("node", "copies", "links", "here", F.coalesce("root", "node").alias("root"))
    classes = scratch(classes.where((F.col("links") > 0) | (F.col("copies") > 1)))
    first = classes.groupBy("root").agg(F.min("here").alias("head"))
    info = classes.join(first, "root").select("node", "copies", "links", "head")
    out = told.drop("sample").join(info, "node", "left")
    alone = F.col("head").isNull()
    same_row = (F.col("id") == F.col("head.id")) & (F.col("fp") == F.col("head.fp"))
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.when(F.col("head.id") > -(2**63), F.col("head.id")).cast(kind)).alias("class_id"),
        F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        "n_shingles",
        (alone | same_row).alias("first"),
        "id",
        "fp",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without all but one row of each class of :func:`similar`: the one with the least id. Columns stay as they are."""
    found = similar(docs, doc_id, text, **options)
    id_, fp, number = (fresh(docs, c) for c in ("_id", "_fp", "_n"))
    key = [F.col("id").alias(id_), F.col("fp").alias(fp)]
    lost = scratch(found.where("not first").select(*key).distinct())
    twice = scratch(found.where("first and n_copies > 1").groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    here = [
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63))) == F.col(id_),
        F.hash(F.coalesce(F.col(f"`{text}`"), F.lit(""))) == F.col(fp),
    ]
    kept = docs.join(lost, here, "left_anti")
    if twice.isEmpty():
        return kept
    again = kept.join(twice, here).withColumn(number, F.row_number().over(W.partitionBy(id_, fp).orderBy(F.lit(1))))
    return kept.join(twice, here, "left_anti").unionByName(again.where(F.col(number) == 1).drop(number, id_, fp))
