"""Support, engineering and people measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions.scalars import least_or_null, ratio, seconds_between
from tidemark.operators import ordered
from tidemark.operators.keys import latest_per_key


def first_response(df: DataFrame, durations: Sequence[str], name: str = "first_response") -> DataFrame:
    """Shortest of several durations, NULL as soon as one is missing, and the plain shortest."""
    return df.select("*", least_or_null(*durations).alias(name), F.least(*durations).alias(f"{name}_any"))


def lead_times(df: DataFrame, start: str, end: str, grains: Sequence[str] = ("month", "day")) -> DataFrame:
    """Mean hours between two stages at several date grains, from one scan: sums per day are rolled up."""
    day = F.to_date(F.col(end))
    daily = df.groupBy(day.alias("day")).agg(F.sum(seconds_between(start, end)).alias("s"), F.count(F.col(start)).alias("n"))
    grain = F.explode(F.array(*[F.lit(g) for g in grains])).alias("grain")
    rows = daily.select("s", "n", "day", grain)
    period = F.coalesce(*[F.when(F.col("grain") == g, F.trunc("day", g) if g != "day" else F.col("day")) for g in grains])
    return rows.groupBy("grain", period.alias("period")).agg((F.sum("s") / F.sum("n") / 3600).alias("mean_hours"), F.sum("n").alias("items"))


def breakout(df: DataFrame, levels: Sequence[Sequence[str]], aggs: Mapping[str, Column], all_label: str = "all") -> DataFrame:
    """The same measures at several grains and over everything, from one scan with GROUPING SETS."""
    cols = list(dict.fromkeys(c for level in levels for c in level))
    sets = [[F.col(c) for c in level] for level in [*levels, []]]
    level_name = F.concat_ws("+", *[F.when(F.grouping(c) == 0, F.lit(c)) for c in cols])
    g = df.groupingSets(sets, *[F.col(c) for c in cols]).agg(level_name.alias("__level"), *[a.alias(n) for n, a in aggs.items()])
    return g.select(F.when(F.col("__level") == "", all_label).otherwise(F.col("__level")).alias("breakout"), *cols, *aggs)


def rolling_rate(df: DataFrame, keys: Sequence[str], month: str, base: str, leavers: str, months: int = 12) -> DataFrame:
    """Trailing mean of a monthly base and trailing sum of leavers; the rate is NULL when leavers exceed the base.

    Input dense at (keys, month) grain: rows per key are bounded by the calendar.
    """
    w = W.partitionBy(*keys).orderBy(month).rowsBetween(-(months - 1), 0)
    out = df.select("*", F.avg(base).over(w).alias("rolling_base"), F.sum(leavers).over(w).alias("rolling_leavers"))
    rate = 1 - ratio("rolling_leavers", "rolling_base")
    return out.withColumn("retention_rate", F.when(F.col("rolling_base") >= F.col("rolling_leavers"), rate))


def nps(df: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Net promoter score: 9-10 counts 100, 7-8 counts 0, 0-6 counts -100."""
    value = F.when(F.col(score) >= 9, 100).when(F.col(score) >= 7, 0).when(F.col(score) >= 0, -100)
    kind = F.when(F.col(score) >= 9, "promoter").when(F.col(score) >= 7, "passive").when(F.col(score) >= 0, "detractor")
    return df.groupBy(*keys).agg(F.avg(value).alias("nps"), F.count(value).alias("responses"),
                                 *[F.count_if(kind == k).alias(f"{k}s") for k in ("promoter", "passive", "detractor")])


def scorecard(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], probs: Mapping[str, float], within: Sequence[str] = (), cut: float = 0.1) -> DataFrame:
    """Percentiles per metric (and ``within`` columns, which are among the ids) after values at or below the ``cut``
    percentile are dropped as outliers."""
    long = df.unpivot(list(ids), [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    group = [*within, "metric"]
    low = ordered.quantiles(long, group, "value", {"__cut": cut})
    kept = long.join(low, group).where(F.col("value") > F.col("__cut")).select(*group, "value")
    return ordered.quantiles(kept, group, "value", probs)


def percent_rank_threshold(df: DataFrame, keys: Sequence[str], x: str, threshold: float) -> DataFrame:
    """Rows at or below a percent rank within their group."""
    return ordered.with_percent_rank(df, keys, x).where(F.col("percent_rank") <= threshold)


def zscore(df: DataFrame, part: Sequence[str], x: str, at: str | None = None) -> DataFrame:
    """Standard score within a group, on the rows of the latest date if one is given."""
    if at:
        df = df.where(F.col(at) == df.agg(F.max(at).alias("m")).scalar())
    out = ordered.with_totals(df, part, {"__m": F.avg(x), "__s": F.stddev_samp(x)})
    return out.withColumn("zscore", ratio(F.col(x) - F.col("__m"), F.col("__s"))).drop("__m", "__s")


def top_issues_by_value(tags: DataFrame, text: str, pattern: str, customer: str, value: DataFrame, value_col: str, n: int) -> DataFrame:
    """References found in text, weighted by the value of the customers that mention them; the n heaviest.

    A customer counts once per reference.
    """
    refs = tags.select(F.col(customer), F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("reference")).distinct()
    g = refs.join(value, customer).groupBy("reference").agg(F.sum(value_col).alias("total_value"), F.count("*").alias("customers"))
    return g.orderBy(F.col("total_value").desc(), "reference").limit(n)


def histogram_mode(df: DataFrame, keys: Sequence[str], x: str, name: str = "mode_value") -> DataFrame:
    """Centre of the fullest of a key's equally wide bins, the lowest on a tie.

    There are as many bins as the greater of two rules asks for: log2 of the count plus one, and the range over twice the middle
    half's width by the cube root of the count. Equal values are one bin; NULLs don't count.
    """
    known = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("__x"))
    half = F.percentile("__x", 0.75) - F.percentile("__x", 0.25)
    size = ordered.with_totals(known, keys, {"__n": F.count("*"), "__lo": F.min("__x"), "__hi": F.max("__x"), "__half": half})
    span = F.col("__hi") - F.col("__lo")
    by_spread = F.when(F.col("__half") > 0, F.ceil(span / (2 * F.col("__half") / F.pow(F.col("__n"), 1.0 / 3))))
    bins = F.when(span > 0, F.greatest(F.ceil(F.log2("__n") + 1), by_spread)).otherwise(1)
    size = size.withColumn("__bins", bins)
    bin_ = F.when(span > 0, F.least(F.floor((F.col("__x") - F.col("__lo")) / (span / F.col("__bins"))), F.col("__bins") - 1)).otherwise(0)
    filled = size.groupBy(*keys, "__lo", "__hi", "__bins", bin_.alias("__bin")).agg(F.count("*").alias("__c"))
    centre = F.col("__lo") + (F.col("__bin") + 0.5) * span / F.col("__bins")
    return filled.groupBy(*keys).agg(F.max_by(centre, F.struct("__c", -F.col("__bin"))).alias(name))


def run_stats(df: DataFrame, keys: Sequence[str], ok: Column, order: Sequence[Column], x: str, n: int, with_mode: bool = False) -> DataFrame:
    """Count, minimum, maximum (and histogram mode) over the last n successful runs per key, cut by rank before the shuffle."""
    last = latest_per_key(df.where(ok), keys, order, n)
    stats = last.groupBy(*keys).agg(F.count("*").alias("occurrences"), F.min(x).alias("min_value"), F.max(x).alias("max_value"))
    return stats.join(histogram_mode(last, keys, x), list(keys), "left") if with_mode else stats
