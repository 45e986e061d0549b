"""Ordered and ranked columns that never need one key's rows in one task.

A plain window puts all rows of a key into one task. That is right for most keys, which share a task with many others, and wrong for a key that
holds a large part of the table. So a bounded sample of (key, order) finds the keys with more than their share of a partition, and splitters
that cut these by volume into ranges of the order. All other keys go through a plain window. In a cut key the window runs in each range, one summary row per range
is carried over the ranges of the key, and the ranges are exchanged once, for the rows and the summary alike.

Every function takes ``block``: nothing, to take the sample itself; a :class:`Cut`, to share one among several calls on the same keys and order; or a
column that is a non-decreasing function of the order (a day, say), to cut all keys by it without a sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark.functions.scalars import ColumnLike, c
from tidemark.session import cut_lineage

BLOCK, KEY = "__block", "__key"
STRIDE = 32


@dataclass
class Cut:
    """The keys that are cut (a row each, with their splitters), or None where there are none."""

    splits: DataFrame | None


Block = ColumnLike | Cut | None


def _key(keys: Sequence[str]) -> Column:
    """The keys as one struct: not NULL itself, and equal to another where all parts are, NULLs included."""
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(1)


def _rank(order: Sequence[str]) -> Column:
    """The order as one struct that compares like it, whatever its columns are called."""
    return F.struct(*[F.col(o).alias(f"__{k}") for k, o in enumerate(order)])


def cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None, sample: int | None = None) -> Cut:
    """Splitters that cut each key with more rows than 1.5 of ``parts`` equal parts of the table into such parts.

    One job reads the keys and the order and brings ``sample`` rows to the driver (32 for each part, 4,096 to 16,384). A table that is
    smaller than the sample is left uncut unless ``parts`` is given. Results don't depend on the sample, only the sizes of tasks do.
    """
    spark = df.sparkSession
    each = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = sample or min(max(4096, 32 * each), 16_384)
    seen = df.select(_key(keys).alias(KEY), _rank(order).alias("__at")).orderBy(F.rand(1)).limit(sample)
    rows = seen.collect()
    if parts is None and len(rows) < sample:
        return Cut(None)
    step = max(1, len(rows) // each)
    often = Counter(r[0] for r in rows)
    at: dict = {k: [] for k, n in often.items() if n > 1.5 * step}
    for k, o in rows:
        if k in at:
            at[k].append(o)
    if not at:
        return Cut(None)
    told = spark.createDataFrame([(k, v, max(1, step)) for k, v in at.items()], T.StructType([
        T.StructField(KEY, seen.schema[KEY].dataType), T.StructField("__all", T.ArrayType(seen.schema["__at"].dataType)), T.StructField("__step", T.IntegerType())]))
    every = F.filter(F.array_sort("__all"), lambda _, k: k % F.col("__step") == F.col("__step") - 1)
    splits = told.select(KEY, every.alias("__splits"))
    return Cut(splits.withColumn("__heads", F.filter("__splits", lambda _, k: k % STRIDE == 0)))


def _laid(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block) -> tuple[DataFrame, Column | None]:
    """Rows with KEY and BLOCK, and which of them lie in cut keys; None if no key is cut."""
    if block is None:
        block = cut(df, keys, order)
    base = df.withColumn(KEY, _key(keys))
    if not isinstance(block, Cut):
        return base.withColumn(BLOCK, c(block)), F.lit(True)
    if block.splits is None:
        return base, None
    rank = _rank(order)
    # two steps of at most STRIDE comparisons each way; the splitters are some rows of a bounded sample
    near = base.join(F.broadcast(block.splits), KEY, "left")
    head = F.size(F.filter("__heads", lambda s: s < rank)) - 1
    fine = F.size(F.filter(F.slice("__splits", head * STRIDE + 1, STRIDE), lambda s: s < rank))
    at = F.when(F.col("__heads").isNull(), -1).when(head < 0, 0).otherwise(head * STRIDE + fine)
    base = near.withColumn(BLOCK, at.cast("int")).drop("__splits", "__heads").repartition(KEY, BLOCK)
    # Rows and summaries read one exchange if both ask for the same columns. So the filter, always true, names all of them, and rand()
    # keeps it above the exchange.
    known = [f.name for f in base.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return base.where(F.xxhash64(*[F.col(f"`{n}`") for n in known]).cast("double") + F.rand(1) > -1e19), F.col(BLOCK) >= 0


def _inner(keys: Sequence[str], hot: Column | None):
    return W.partitionBy(*keys) if hot is None else W.partitionBy(KEY, BLOCK)


def _carried(rows: DataFrame, carry: DataFrame, block: Block) -> DataFrame:
    """Rows with the summary carried to their block. That of a :class:`Cut` has a row per block, bounded by its sample."""
    bounded = block is None or isinstance(block, Cut)
    return rows.join(F.broadcast(carry) if bounded else carry, [KEY, BLOCK], "left")


def _neighbour(df, keys, order, block, values, forward: bool) -> DataFrame:
    keys, names = list(keys), list(values)
    base, hot = _laid(df, keys, order, block)
    packed = F.struct(*[c(v).alias(n) for n, v in values.items()])
    shift = F.lead if forward else F.lag
    out = base.withColumn("__near", shift(packed).over(_inner(keys, hot).orderBy(*order)))
    got = F.col("__near")
    if hot is not None:
        rank = _rank(order)
        edge = (F.min_by if forward else F.max_by)(packed, rank)
        edges = base.where(hot).groupBy(KEY, BLOCK).agg(edge.alias("__edge"))
        edges = edges.select(KEY, BLOCK, shift("__edge").over(W.partitionBy(KEY).orderBy(BLOCK)).alias("__carry"))
        out, got = _carried(out, edges, block), F.coalesce("__near", "__carry")
    return out.select(*[F.col(x) for x in df.columns], *[got[n].alias(n) for n in names])


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike]) -> DataFrame:
    """Values of the preceding row per key (``lag``).

    ``order`` must be a total ascending order of non-null columns. NULL keys are a key of their own, as in a window.
    """
    return _neighbour(df, keys, order, block, values, forward=False)


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike]) -> DataFrame:
    """Values of the following row per key (``lead``); same contract as ``with_previous``."""
    return _neighbour(df, keys, order, block, values, forward=True)


def with_next_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike],
                   n: int, name: str) -> DataFrame:
    """Array of the next n rows' values per key, nearest first; shorter at the end of the key.

    Every block of a cut key passes on its first n rows only (cut by rank before the shuffle), and a block looks at the n blocks
    after it, each of which has a row.
    """
    keys = list(keys)
    base, hot = _laid(df, keys, order, block)
    packed = F.struct(*[c(v).alias(x) for x, v in values.items()])
    inner = _inner(keys, hot).orderBy(*order)
    out = base.withColumn("__near", F.collect_list(packed).over(inner.rowsBetween(1, n)))
    ahead = F.col("__near")
    if hot is not None:
        outer = W.partitionBy(KEY).orderBy(BLOCK)
        heads = base.where(hot).select(KEY, BLOCK, *order, packed.alias("__v")).withColumn("__rn", F.row_number().over(inner)).where(F.col("__rn") <= n)
        heads = heads.groupBy(KEY, BLOCK).agg(F.array_sort(F.collect_list(F.struct("__rn", "__v"))).alias("__first"))
        later = F.flatten(F.collect_list("__first").over(outer.rowsBetween(1, n)))
        heads = heads.select(KEY, BLOCK, F.transform(later, lambda x: x["__v"]).alias("__carry"))
        out = _carried(out, heads, block)
        ahead = F.slice(F.concat("__near", F.coalesce("__carry", F.slice("__near", 1, 0))), 1, n)
    return out.select(*[F.col(x) for x in df.columns], ahead.alias(name))


def with_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, sums: Mapping[str, ColumnLike]) -> DataFrame:
    """Running totals per key up to and including the row."""
    keys = list(keys)
    base, hot = _laid(df, keys, order, block)
    inner = _inner(keys, hot).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = base.select("*", *[F.sum(c(v)).over(inner).alias(f"__i_{n}") for n, v in sums.items()])
    total = {n: F.col(f"__i_{n}") for n in sums}
    if hot is not None:
        before = W.partitionBy(KEY).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
        totals = base.where(hot).groupBy(KEY, BLOCK).agg(*[F.sum(c(v)).alias(f"__t_{n}") for n, v in sums.items()])
        carry = totals.select(KEY, BLOCK, *[F.sum(f"__t_{n}").over(before).alias(f"__c_{n}") for n in sums])
        out = _carried(out, carry, block)
        total = {n: F.coalesce(F.col(f"__c_{n}") + F.col(f"__i_{n}"), f"__c_{n}", f"__i_{n}") for n in sums}
    return out.select(*[F.col(x) for x in df.columns], *[v.alias(n) for n, v in total.items()])


def with_islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike],
                 opens: Callable[[Column], Column], name: str) -> DataFrame:
    """1-based number of the run of rows a row belongs to; ``opens(prev)`` says whether a row starts a new run.

    ``prev`` is the struct of the preceding row's ``values``. A key's first row always opens. One summary row per
    block of a cut key holds its first and last values and the openings inside it, which settles both the previous row of a
    block's first row and the count of openings before it.
    """
    keys = list(keys)
    base, hot = _laid(df, keys, order, block)
    packed = F.struct(*[c(v).alias(n) for n, v in values.items()])
    inner = _inner(keys, hot).orderBy(*order)
    seen = base.withColumn("__cur", packed).withColumn("__near", F.lag(packed).over(inner))

    def flag(prev: Column) -> Column:
        return F.coalesce(opens(prev), F.lit(True)).cast("long")

    seen = seen.withColumn("__open", F.when(F.col("__near").isNotNull(), flag(F.col("__near"))))
    so_far = F.coalesce(F.sum("__open").over(inner.rowsBetween(W.unboundedPreceding, 0)), F.lit(0))
    out, first = seen.withColumn("__so_far", so_far), F.lit(1)
    if hot is not None:
        rank, outer = _rank(order), W.partitionBy(KEY).orderBy(BLOCK)
        edge = [F.min_by(F.col(x), rank).alias(f"__f_{x}") for x in df.columns if x not in keys]
        blocks = seen.where(hot).groupBy(KEY, BLOCK).agg(F.sum("__open").alias("__inside"), F.max_by("__cur", rank).alias("__last"), *edge)
        blocks = blocks.withColumn("__carry", F.lag("__last").over(outer))
        # the first row of the block as a row of its own, so that ``opens`` can be asked about it
        heads = blocks.select(*[F.col(KEY)[x].alias(x) if x in keys else F.col(f"__f_{x}").alias(x) for x in df.columns], KEY, BLOCK, "__inside", "__carry")
        heads = heads.withColumn("__head", F.when(F.col("__carry").isNull(), F.lit(1).cast("long")).otherwise(flag(F.col("__carry"))))
        before = F.sum(F.col("__head") + F.coalesce("__inside", F.lit(0))).over(outer.rowsBetween(W.unboundedPreceding, -1))
        heads = heads.select(KEY, BLOCK, (F.coalesce(before, F.lit(0)) + F.col("__head")).alias("__base"))
        out, first = _carried(out, heads, block), F.coalesce("__base", F.lit(1))
    return out.select(*[F.col(x) for x in df.columns], (first + F.col("__so_far")).alias(name))


def with_row_index(df, keys, order, block: Block = None, name: str = "row_index") -> DataFrame:
    """1-based position of the row within its key."""
    return with_running_sum(df, keys, order, block, {name: F.lit(1).cast("long")})


def _known(df, keys, order, block, values, forward: bool) -> DataFrame:
    keys = list(keys)
    base, hot = _laid(df, keys, order, block)
    rank = _rank(order)
    if forward:
        sort, block_sort, edge = [F.col(o).desc() for o in order], F.col(BLOCK).desc(), F.min_by
    else:
        sort, block_sort, edge = [F.col(o) for o in order], F.col(BLOCK), F.max_by
    inner = _inner(keys, hot).orderBy(*sort).rowsBetween(W.unboundedPreceding, 0)
    out = base.select("*", *[F.last(c(v), ignorenulls=True).over(inner).alias(f"__i_{n}") for n, v in values.items()])
    got = {n: F.col(f"__i_{n}") for n in values}
    if hot is not None:
        before = W.partitionBy(KEY).orderBy(block_sort).rowsBetween(W.unboundedPreceding, -1)
        edges = base.where(hot).groupBy(KEY, BLOCK).agg(*[edge(c(v), F.when(c(v).isNotNull(), rank)).alias(f"__e_{n}") for n, v in values.items()])
        carry = edges.select(KEY, BLOCK, *[F.last(f"__e_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in values])
        out, got = _carried(out, carry, block), {n: F.coalesce(f"__i_{n}", f"__c_{n}") for n in values}
    return out.select(*[F.col(x) for x in df.columns], *[v.alias(n) for n, v in got.items()])


def with_last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike]) -> DataFrame:
    """Last non-null value per key up to and including the row (forward fill)."""
    return _known(df, keys, order, block, values, forward=False)


def with_next_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Block, values: Mapping[str, ColumnLike]) -> DataFrame:
    """First non-null value per key from the row on (backward fill)."""
    return _known(df, keys, order, block, values, forward=True)


def with_totals(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group totals beside every row: aggregate with map-side combine, then join back."""
    if not keys:
        totals = df.agg(*[a.alias(n) for n, a in aggs.items()])
        return df.select("*", *[totals.select(n).scalar().alias(n) for n in aggs])
    totals = df.groupBy(_key(keys).alias(KEY)).agg(*[a.alias(n) for n, a in aggs.items()])
    return df.withColumn(KEY, _key(keys)).join(totals, KEY, "left").select(*[F.col(x) for x in df.columns], *aggs)


def with_cumulative_count(df, keys, x) -> DataFrame:
    """Distinct (key, value) rows with ``__below`` rows smaller, ``__n`` rows equal and ``__total`` rows in the key. ``keys`` may be empty."""
    counts = df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count("*").alias("__n"))
    run = with_running_sum(counts, keys, [x], None, {"__upto": "__n"})
    run = with_totals(run, keys, {"__total": F.sum("__n")})
    return run.withColumn("__below", F.col("__upto") - F.col("__n")).drop("__upto")


def with_percent_rank(df: DataFrame, keys: Sequence[str], x: str, name: str = "percent_rank") -> DataFrame:
    """``percent_rank`` of x within the keys: rows below divided by rows less one. NULLs of x give NULL."""
    ranks = with_cumulative_count(df, keys, x)
    ranks = ranks.select(
        _key(keys).alias(KEY), x,
        F.when(F.col("__total") == 1, F.lit(0.0)).otherwise(F.col("__below") / (F.col("__total") - 1)).alias(name),
    )
    return df.withColumn(KEY, _key(keys)).join(ranks, [KEY, x], "left").select(*[F.col(v) for v in df.columns], name)


def quantiles(df: DataFrame, keys: Sequence[str], x: str, probs: Mapping[str, float], most: int = 1_000_000, cells: int = 1024) -> DataFrame:
    """Exact continuous quantiles per key (linear interpolation between the neighbouring ranks), as ``percentile`` gives them.

    A key of up to ``most`` values is left to ``percentile``, which holds the distinct values of a key in memory, once for all quantiles. Larger
    ones are narrowed, see :func:`_narrowed`. One job counts the values of each key first.
    """
    values = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("__x"))
    sizes = values.groupBy(_key(keys).alias(KEY)).agg(F.count("*").alias("__rows"))
    large = cut_lineage(sizes.where(F.col("__rows") > most))  # at most a row per ``most`` values of the table, so it may be broadcast
    every = F.percentile("__x", F.array(*[F.lit(float(p)) for p in probs.values()])).alias("__every")
    named = [F.get("__every", F.lit(k)).alias(n) for k, n in enumerate(probs)]
    if large.isEmpty():
        return values.groupBy(*keys).agg(every).select(*keys, *named)
    keyed = values.select(_key(keys).alias(KEY), "__x")
    small = keyed.join(F.broadcast(large), KEY, "left_anti").groupBy(KEY).agg(every).select(KEY, *named)
    return small.unionByName(_narrowed(keyed, large, probs, most, cells)).select(*[F.col(KEY)[k].alias(k) for k in keys], *probs)


def _narrowed(rows: DataFrame, sizes: DataFrame, probs: Mapping[str, float], most: int, cells: int) -> DataFrame:
    """Quantiles of ``__x`` per KEY of ``sizes`` (``__rows`` values each), from ever fewer of them.

    A sketch gives ``cells`` edges of about equal depth, off by less than a fifth of a cell in rank. The cell that holds a wanted rank and its
    neighbours make the bracket that surely holds it; the rows below a bracket are counted exactly, those inside go into the
    next round, until no bracket holds more than ``most`` or none gets smaller, as when its few values are
    repeated ever so often. The last round alone sorts, distinct values with their counts, about ``most`` per quantile however large the
    table. Each round divides the rows by some ``cells`` / 4. Rows never meet by key before that: brackets, at most one per quantile and ``most`` values
    of the table, are sent to the rows.
    """
    names = list(probs)
    shares = [k / cells for k in range(cells + 1)]
    state = sizes.select(
        KEY, F.explode(F.array(*[F.struct(F.lit(n).alias("__name"), (F.lit(p) * (F.col("__rows") - 1)).alias("__pos")) for n, p in probs.items()])).alias("__w"),
        F.lit(0).cast("long").alias("__below"), F.col("__rows").alias("__n")).select(KEY, "__w.*", "__below", "__n")
    active = rows.join(F.broadcast(sizes.select(KEY)), KEY)
    at, on = [KEY, "__name"], [KEY]  # in the first round, one sketch and the same rows for all quantiles
    while True:
        sketched = active.groupBy(*on).agg(F.percentile_approx("__x", shares, 5 * cells).alias("__edges"))
        state = state.join(sketched, on)
        cell = (F.col("__pos") - F.col("__below")) / F.greatest(F.col("__n") - 1, F.lit(1)) * cells
        # a rank sits at most a cell beside where the sketch has it, and the rank after it is wanted too
        low = F.get("__edges", F.greatest(F.floor(cell) - 1, F.lit(0)).cast("int"))
        high = F.get("__edges", F.least(F.ceil(cell) + 2, F.lit(cells)).cast("int"))
        done = F.col("__n") <= max(most, 2 * cells)
        low = F.when(done | (F.floor(cell) - 1 <= 0), F.lit(float("-inf"))).otherwise(low)
        high = F.when(done | (F.ceil(cell) + 2 >= cells), F.lit(float("nan"))).otherwise(high)  # NaN sorts last
        state = cut_lineage(state.select(*at, "__pos", F.col("__below").alias("__before"), F.col("__n").alias("__was"), low.alias("__low"), high.alias("__high")))
        near = active.join(F.broadcast(state), on).where(F.col("__x") <= F.col("__high"))
        inside = F.col("__x") >= F.col("__low")
        counts = near.groupBy(*at).agg(F.count_if(~inside).alias("__less"), F.count_if(inside).alias("__n"))
        state = state.join(counts, at).select(*at, "__pos", (F.col("__before") + F.col("__less")).alias("__below"), "__n", "__was", "__low", "__high")
        state = cut_lineage(state)
        active = active.join(F.broadcast(state.select(*at, "__low", "__high")), on).where(F.col("__x").between(F.col("__low"), F.col("__high"))).select(*at, "__x")
        if state.where((F.col("__n") > most) & (F.col("__n") < F.col("__was"))).isEmpty():
            break
        active, on = cut_lineage(active), at
        state = state.select(*at, "__pos", "__below", "__n")

    # distinct values with their counts: a bracket of equal values is one row
    counts = active.groupBy(*at, "__x").agg(F.count("*").alias("__k")).join(F.broadcast(state.select(*at, "__pos", "__below")), at)
    upto = F.col("__below") + F.sum("__k").over(W.partitionBy(*at).orderBy("__x").rowsBetween(W.unboundedPreceding, 0))
    placed = counts.withColumn("__upto", upto)

    def value(r: Column) -> Column:
        return F.max(F.when((F.col("__upto") - F.col("__k") <= r) & (r < F.col("__upto")), F.col("__x")))

    got = placed.groupBy(*at).agg(value(F.floor("__pos")).alias("__a"), value(F.ceil("__pos")).alias("__b"), F.max(F.col("__pos") - F.floor("__pos")).alias("__f"))
    got = got.select(*at, (F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__f")).alias("__q"))
    return got.groupBy(KEY).agg(*[F.max(F.when(F.col("__name") == n, F.col("__q"))).alias(n) for n in names])
