"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Every document of a source gets the same expected number of copies, target / size of its source. Laid end to end, these
expectations form a line from 0 to the source's number of copies; one random offset shifts the line, and a document is emitted
once for each whole number in its piece. So copies differ from the expectation by less than one for every run of neighbours, and as
neighbours have like sizes, the words taken stay near the target.

The line is a prefix sum, and a source may hold a third of all rows. A document's place is therefore found from cells
(source, size class, bucket of its id): counts per cell are summed over the cells of a source (bounded by classes x buckets), and only
within a cell are documents ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, n_words, scratch, unit


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, at_most: float) -> DataFrame:
    """``source, source_size`` -> also ``target``: ``share`` of all sizes dealt by repeating weights, none above ``at_most`` times its size.

    Dealing the excess anew until none is above ends where target = min(at_most * size, level * weight). Sources fill up in the order of
    at_most * size / weight: taking the first k as full leaves a level that rises up to the right k and falls after it. So the level is the
    greatest of these, and running sums give them all. One row per source goes through one task.
    """
    every = W.partitionBy()
    ranked = sources.withColumn("_k", F.row_number().over(W.orderBy(F.encode("source", "UTF-8").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    filled = W.orderBy(F.col("_most") / F.col("_w"), "_k")
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    level = left / F.sum("_w").over(filled.rowsBetween(W.currentRow, W.unboundedFollowing))
    return (
        ranked.withColumn("_w", weight)
        .withColumn("_most", at_most * F.col("source_size"))
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(every))
        .select("source", "source_size", F.least("_most", F.col("_level") * F.col("_w")).alias("target"))
    )


def copies(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    at_most: float = 2.0,
    buckets: int = 64,
    seed: str = "mix",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Columns ``row`` (a struct of the columns of ``docs``), ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``at_most``, rounded up).

    A null source is a source of its own, the last one. A null or empty text has size 0 and shares the expectation of its source; a
    source of size 0 yields no copies. Equal ids are ranked by size; equal rows may swap their copies, which no result shows. Extra columns,
    whatever their names, stay in ``row``. No rows give no rows. The same rows give the same copies in any layout, as places follow from
    ids.
    """
    at = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        size.cast("long").alias("size"),
        F.col(f"`{source}`").alias("source"),
        F.col(f"`{doc_id}`").alias("id"),
    )
    # a struct isn't null and equals another where all parts do, so null sources meet and rows are dealt out only once
    kind = F.floor(16 * F.log2(F.col("size") + 1.5)).cast("int").alias("class")
    bucket = F.floor(buckets * unit(seed, F.coalesce(F.col("id").cast("string"), F.lit("")))).cast("int").alias("bucket")
    at = at.select("row", "size", "id", F.struct("source", kind, bucket).alias("cell"))

    cells = scratch(at.groupBy("cell").agg(F.count("*").alias("n"), F.sum("size").cast("double").alias("words")))
    line = W.partitionBy("cell.source").orderBy("cell.class", "cell.bucket").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0)))
    aims = targets(cells.groupBy(F.col("cell.source").alias("source")).agg(F.sum("words").alias("source_size")), weights, share, at_most)
    aims = aims.select(
        F.col("source").alias("aim"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )
    cells = cells.join(aims, F.col("cell.source").eqNullSafe(F.col("aim")), "left").select(
        "cell", "before", "rate", F.col("source_size").cast("long").alias("source_size"), "target"
    )
    placed = at.withColumn("rank", F.row_number().over(W.partitionBy("cell").orderBy("size", "id")))
    both = placed.join(cells, "cell").withColumn("source", F.col("cell.source"))
    offset = unit(seed, F.col("source").isNull(), F.coalesce("source", F.lit("")))
    end = F.col("before") + F.col("rank")
    emitted = F.floor(F.col("rate") * end + offset) - F.floor(F.col("rate") * (end - 1) + offset)
    return both.select("row", "size", "source_size", "target", emitted.cast("long").alias("copies"))


def mix(docs: DataFrame, text: str = "text", copy: str = "copy", **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` once for every copy, with its number from 1 in a further column ``copy``. Sizes are words of ``text``."""
    dealt = copies(docs, n_words(F.col(f"`{text}`")), **options).where("copies > 0")
    number = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(fresh(docs, copy))
    return dealt.select("row.*", number)
