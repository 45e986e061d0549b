"""How far each source's choice of terms lies from the other sources of its language, in exact whole numbers.

Terms are counted in the workers by :mod:`tidemark.llm.packing`, some megabytes of text at a time, and the counts added up in Spark. A
group (language, source) gives each kept term of the language a share p of a billion, smoothed by one occurrence; two groups differ by the sum of
(p - q)^2 / q over all kept terms, each rounded down.

Most terms don't occur in most groups, and all those have one share in a group, so nothing is summed over (term, group, group):

* all terms as if neither group had them: the number of terms times one value;
* for a term that one of both has, what that changes: told by how many terms of a group have the same share;
* for a term that both have, what is left: summed in the workers over the groups of each term.

The report has a row for each ordered pair of sources in a language, so its size is the square of their number by definition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import packing, rolling
from tidemark.llm.common import scratch, smaller_batches

SCALE = 1_000_000_000


def _count(most: int):
    """Texts with ``lang`` and ``source`` -> partial counts of (lang, source, term), and a row without term for each group."""
    shape = {"lang": pa.string(), "source": pa.string(), "term": pa.binary(), "n": pa.int64(), "docs": pa.int64()}

    def told(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        names = list(zip(table["lang"].to_pylist(), table["source"].to_pylist(), strict=True))
        known = {x: k for k, x in enumerate(dict.fromkeys(names))}
        lang, source = (pa.array(x, pa.string()) for x in zip(*known, strict=True))
        group = np.array([known[x] for x in names], np.int64)
        none = [0] * len(known)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((lang, source, [None] * len(known), none, none), shape.values(), strict=True)], names=list(shape))
        data, offsets = rolling.utf8(table["text"].combine_chunks())
        for found, of_group, n, docs in packing.counted(data, offsets, group):
            for i in range(0, len(found), 65536):
                own = pa.array(of_group[i : i + 65536])
                yield pa.RecordBatch.from_arrays(
                    [lang.take(own), source.take(own), pa.array(found[i : i + 65536], pa.binary()), pa.array(n[i : i + 65536]), pa.array(docs[i : i + 65536])],
                    names=list(shape),
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            if not len(b):
                continue
            held.append(b)
            size += b["text"].nbytes
            if size >= most:
                yield from told(held)
                held, size = [], 0
        if held:
            yield from told(held)

    return run


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", most: int = 1 << 23) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term, over all rows; also a row with null ``term`` per group.

    Nulls count as empty. Workers count ``most`` bytes of texts at once, or one longer text.
    """
    smaller_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = rows.mapInArrow(_count(most), "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exactly; null where ``total`` is 0."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, F.nullif(total, F.lit(0)).cast("decimal(19,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _both(pairs_at_once: int = 2_000_000):
    """Groups of each term -> for each ordered pair of groups, what terms of both add beside what either alone explains."""
    def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b["own"]
            size = lists.value_lengths().to_numpy().astype(np.int64)
            e = lists.flatten()
            coded, langs = e.field("source").dictionary_encode(), b["lang"].dictionary_encode()
            s, p, rest = coded.indices.to_numpy().astype(np.int64), e.field("p").to_numpy(), e.field("rest").to_numpy()
            lang, names = langs.indices.to_numpy().astype(np.int64), coded.dictionary
            first, n = np.cumsum(size) - size, len(names)
            done = np.cumsum(size**2) // pairs_at_once
            for part in np.unique(done):
                rows = np.flatnonzero(done == part)
                i = np.repeat(np.concatenate([np.arange(first[r], first[r] + size[r]) for r in rows]), np.repeat(size[rows], size[rows]))
                of = np.repeat(rows, size[rows] ** 2)
                within = np.arange(len(of)) - np.repeat(np.cumsum(size[rows] ** 2) - size[rows] ** 2, size[rows] ** 2)
                j = first[of] + within % size[of]
                i, j, of = (x[i != j] for x in (i, j, of))
                if not len(i):
                    continue
                left = far(p[i], p[j]) - far(p[i], rest[j]) - far(rest[i], p[j]) + far(rest[i], rest[j])
                key, back = np.unique((lang[of] * n + s[i]) * n + s[j], return_inverse=True)
                sums = np.zeros(len(key), np.int64)
                np.add.at(sums, back, left)
                take = [langs.dictionary.take(pa.array(key // n**2)), names.take(pa.array(key // n % n)), names.take(pa.array(key % n))]
                yield pa.RecordBatch.from_arrays([*take, pa.array(sums)], names=["lang", "source", "item", "value"])

    return run


def audit(docs: DataFrame, least: int = 3, ranks: int = 200, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: sources that differ most from each source, and the terms it stands out by.

    Part ``pair``: ``item`` is another source of the language, ``value`` the sum over kept terms. Part ``term``: ``item`` is a kept term more common in
    the group than in its language, ``value`` its distance, only the first ``ranks``. Kept are the terms in at least ``least``
    documents of the language. Null languages, sources and texts are empty ones; a group without terms has pairs all the same, with value 0 if
    the language keeps no term. A repeated row is a document of its own. No rows give no rows; other columns aren't read.
    """
    counts = scratch(term_counts(docs, lang, source, text))
    # all a language knows of a term in one row: as many entries as sources have it
    kept = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("own")
    )
    kept = scratch(kept.where(F.col("docs") >= least).select("lang", "term", "n", "own"))
    cells = kept.select("lang", "term", F.col("n").alias("in_lang"), F.inline("own"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("types"), F.sum("n").alias("tokens"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select(
        "lang", "source", F.coalesce("types", F.lit(0)).alias("types"), (F.coalesce("n", F.lit(0)) + F.col("types")).alias("total"),
        (F.col("tokens") + F.col("types")).alias("in_all"),
    )
    groups = scratch(groups.withColumn("rest", _share(F.lit(0), F.col("total"))))
    told = scratch(cells.join(groups.select("lang", "source", "total", "rest", "in_all"), ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("n"), F.col("total")).alias("p"), "rest", _share(F.col("in_lang"), F.col("in_all")).alias("q")
    ))

    here, there = groups.select("lang", "source", "rest", "types"), groups.select("lang", F.col("source").alias("item"), F.col("rest").alias("rest_2"))
    exact = "decimal(38,0)"
    neither = here.join(there, "lang").where("source <> item").select(
        "lang", "source", "item", F.coalesce(F.col("types").cast(exact) * _apart(F.col("rest"), F.col("rest_2")), F.lit(0)).cast(exact).alias("value")
    )
    alike = scratch(told.groupBy("lang", "source", "p", "rest").agg(F.count("*").alias("n")))
    one = alike.join(there, "lang").where("source <> item")
    forth = one.select("lang", "source", "item", (F.col("n").cast(exact) * (_apart(F.col("p"), F.col("rest_2")) - _apart(F.col("rest"), F.col("rest_2")))).cast(exact).alias("value"))
    back = one.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"),
        (F.col("n").cast(exact) * (_apart(F.col("rest_2"), F.col("p")) - _apart(F.col("rest_2"), F.col("rest")))).cast(exact).alias("value"),
    )
    shared = told.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "rest")).alias("own")).where(F.size("own") > 1)
    both = shared.select("lang", "own").mapInArrow(_both(), "lang string, source string, item string, value long")
    pairs = neither.unionByName(forth).unionByName(back).unionByName(both.withColumn("value", F.col("value").cast(exact)))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    by_value = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    out = told.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    return pairs.unionByName(out.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= ranks))
