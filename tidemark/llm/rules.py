"""Quality rules whose cutoffs are chosen under a guaranteed risk. DataFrame functions only.

A rule compares one ratio of a document with a cutoff. Which cutoff is safe is learned from labelled documents: in each stratum, every
cutoff of a grid fixed beforehand is tested for "rejects at most its share of ``risk`` of the good documents", where the rules share the
risk equally: all of them together reject at most ``risk`` of a stratum's good documents. With k of n good ones rejected, the test
passes when a binomial count of n trials with that chance would be k or lower with probability at most ``error`` / number of tests
(the exact one-sided bound of Clopper and Pearson, with Bonferroni's correction over strata, rules and cutoffs). So with probability
1 - ``error`` all chosen cutoffs keep their promise at once. Among the safe cutoffs of a rule the one that parts good from bad best is taken;
a rule that parts nothing rejects nothing. Too few labels in a stratum prove nothing, and then no rule acts there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, fresh, scratch, words


@dataclass(frozen=True)
class Rule:
    name: str
    above: bool  # rejects values above its cutoff, else below
    top: str
    bottom: str
    grid: tuple[float, ...]  # from lenient to strict


RULES = (
    Rule("symbols", True, "n_symbols", "n_words", (2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)),
    Rule("repeats", True, "n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("duplicate_lines", True, "n_dup_lines", "n_lines", (0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05)),
    Rule("capitals", True, "n_capitals", "word_chars", (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1)),
    Rule("exclamations", True, "n_exclamations", "n_words", (2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("long_words", True, "word_chars", "n_words", (16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0)),
    Rule("short_words", False, "word_chars", "n_words", (1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5)),
)
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations")


def _count(text: Column, chars: str) -> Column:
    """Number of characters of a class, by dropping all others."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def statistics(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep`` and the counts in STATS of every whole text; null counts as empty.

    Repeated words: within one row, windows of three words are hashed and sorted with their places; equal neighbours are the repeated
    ones, and each adds the words that the next one doesn't cover.
    """
    t, w, h, s, p, ln = (fresh(docs, c) for c in ("_t", "_w", "_h", "_s", "_p", "_lines"))
    kept = [c.alias(f"_keep{i}") for i, c in enumerate(keep)]
    df = docs.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(t))
    df = df.select("*", words(F.col(t)).alias(w), F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(ln))
    n = F.size(w)
    df = df.select(
        "*",
        F.when(n > 2, F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(1))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
        .otherwise(F.array().cast("array<bigint>")).alias(h),
    )
    pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    df = df.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(pairs)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    df = df.withColumn(p, F.sort_array(F.transform(twice, lambda x: x["p"])))
    adds = F.transform(p, lambda x, i: F.coalesce(F.least(F.lit(3), F.get(p, i + 1) - x), F.lit(3)))
    return df.select(
        *[F.col(f"_keep{i}").alias(docs.select(c).columns[0]) for i, c in enumerate(keep)],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, WHITE, "")).cast("long").alias("word_chars"),
        _count(F.col(t), "#*$%&|<>").alias("n_symbols"),
        F.size(ln).cast("long").alias("n_lines"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        F.aggregate(adds, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"),
        _count(F.col(t), r"\p{Lu}").alias("n_capitals"),
        _count(F.col(t), "!").alias("n_exclamations"),
    )


def base_failed() -> Column:
    """The fixed rules that come first: too short, or mostly repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _passed(rule: Rule) -> Column:
    """How many cutoffs of the grid, from lenient to strict, would reject this row."""
    value = F.col(rule.top) / F.when(F.col(rule.bottom) > 0, F.col(rule.bottom))
    hit = [F.coalesce((value > c) if rule.above else (value < c), F.lit(False)).cast("int") for c in rule.grid]
    return sum(hit[1:], hit[0])


def strictness(rules: tuple[Rule, ...] = RULES) -> Column:
    """Array with an entry per rule: len(grid) - passed + 1 is the place of the most lenient cutoff that rejects the row."""
    return F.array(*[_passed(r) for r in rules])


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, eight steps up, where its error is below 1e-15."""
    z = n + F.lit(9.0)
    series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    steps = n + 1.0
    for k in range(2, 9):
        steps = steps * (n + float(k))
    return series - F.ln(steps)


def binomial_tail(k: Column, n: Column, chance: float) -> Column:
    """P(X <= k) for X binomial(n, chance); 1 where k is not below the mean (no cutoff passes there)."""
    k, n = k.cast("double"), n.cast("double")
    top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(chance) + (n - k) * math.log1p(-chance)
    odds = (1 - chance) / chance
    below = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0.0)).cast("long")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, i: F.struct(
            (a["term"] * ((k - i) / (n - k + i + 1) * odds)).alias("term"),
            (a["sum"] + a["term"] * ((k - i) / (n - k + i + 1) * odds)).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when((n <= 0) | (k >= n * chance), 1.0).otherwise(F.exp(top) * below)


def choose(
    held: DataFrame,
    stratum: str = "stratum",
    good: str = "good",
    rules: tuple[Rule, ...] = RULES,
    risk: float = 0.05,
    error: float = 0.05,
) -> DataFrame:
    """Labelled rows (``stratum``, ``good`` boolean, counts) -> ``stratum, cutoffs``: map from a rule's index to the place of its cutoff.

    ``risk`` is promised for a stratum, whatever its rules. A row of labels without document or with a null label must be left out before; no rows give no cutoffs.
    """
    cells = (
        held.select(F.col(stratum).alias("stratum"), F.col(good).alias("good"), F.posexplode(strictness(rules)).alias("rule", "passed"))
        .groupBy("stratum", "rule", "passed")
        .agg(F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad"))
    )
    one = W.partitionBy("stratum", "rule")
    strict_first = one.orderBy(F.col("passed").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    strata = cells.select("stratum").distinct().agg(F.count("*").alias("strata"))
    tests = F.col("strata") * sum(len(r.grid) for r in rules)
    found = cells.select(
        "*",
        F.sum("good").over(one).alias("n"),
        F.sum("bad").over(one).alias("n_bad"),
        F.sum("good").over(strict_first).alias("k"),
        F.sum("bad").over(strict_first).alias("k_bad"),
    ).where("passed > 0")
    found = found.withColumn("strata", F.lit(int(strata.first()[0])))
    gain = F.col("k_bad") * F.col("n") - F.col("k") * F.col("n_bad")
    safe = found.where((gain > 0) & (binomial_tail(F.col("k"), F.col("n"), risk / len(rules)) * tests <= error))
    best = safe.groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), F.col("passed").alias("passed")))["passed"].alias("passed"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "passed"))).alias("cutoffs"))


def judge(stats: DataFrame, cutoffs: DataFrame, stratum: str = "stratum", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``stats`` with ``base_failed``, ``rejected_by`` (names of the rules) and ``kept``."""
    told = cutoffs.select(F.col("stratum").alias("_told"), F.col("cutoffs").alias("_cutoffs"))
    named = [
        F.when(_passed(r) >= F.element_at("_cutoffs", F.lit(i)), F.lit(r.name))
        for i, r in enumerate(rules)
    ]
    return (
        stats.join(told, F.col(stratum) == F.col("_told"), "left")
        .withColumn("rejected_by", F.array_compact(F.array(*named)))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("_told", "_cutoffs")
    )


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", stratum: str = "lang", **options) -> DataFrame:
    """A row per document: ``doc_id``, ``stratum``, the counts, ``base_failed``, ``rejected_by``, ``kept``.

    ``labels`` has the id and ``quality`` (1 good, 0 bad, null unknown); strata are values of ``stratum``, null and empty being one. Null and
    empty texts have no words and fail the base; a row without label is judged all the same; a repeated label counts as often as it stands;
    repeated documents are judged alike; no rows give no rows. Cutoffs are tested on labelled documents that pass the base.
    """
    id_ = F.col(f"`{doc_id}`").alias("doc_id")
    stats = scratch(statistics(docs, text, [id_, F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")).alias("stratum")]))
    told = labels.select(F.col(f"`{doc_id}`").alias("_id"), (F.col("quality") == 1).alias("good")).where("good is not null")
    held = stats.where(~base_failed()).join(told, F.col("doc_id") == F.col("_id")).drop("_id")
    return judge(stats, scratch(choose(held, **options)))
