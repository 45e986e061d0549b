"""URL filters: path rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions and Spark ML only.

The trees learn from labelled URLs, given or those that a rule decides, and are tested on held-out ones. A URL is described by lengths, depth, counts and ratios of its
characters, their entropy, parameters, and how common its host's suffixes are among all URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch

A, Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class PathRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, whole, 1), A, Z), F.regexp_extract(url, whole, 2)


def ruled(urls: DataFrame, rules: list[PathRule] | DataFrame) -> DataFrame:
    """``host, path`` of any rows -> distinct ``_host, _path, rule, verdict`` of those that a rule fits: the longest, of equal lengths the first by name.

    ``rules`` may be a table (``verdict, host, path``) of any length: a host's suffixes meet the rules' hosts by equality, and of these the
    rules whose path the URL's starts with count.
    """
    spark = urls.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    told = table.select("verdict", F.col("host").alias("_suffix"), F.col("path").alias("_prefix"), F.concat("host", "path").alias("rule"))
    pairs = urls.select(F.col("host").alias("_host"), F.col("path").alias("_path")).where("host <> ''").distinct()
    labels = F.split("_host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, n, F.size(labels)), "."))
    met = pairs.withColumn("_suffix", F.explode(suffixes)).join(told, "_suffix").where(F.startswith("_path", F.col("_prefix")))
    longest = F.struct(-F.length("rule"), F.col("rule"))
    return met.groupBy("_host", "_path").agg(F.min_by(F.struct("rule", "verdict"), longest).alias("_fit")).select("_host", "_path", "_fit.*")


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of one URL, all doubles; an empty URL has zeros."""
    n = F.nullif(F.length(url).cast("double"), F.lit(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    letters = F.array_distinct(F.split(url, ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    digits = F.length(F.regexp_replace(url, "[^0-9]+", ""))
    last = F.element_at(F.split(path, "/"), -1)
    found = {
        "url_length": n,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.array_remove(F.split(path, "/"), "")),
        "labels": F.when(host == "", 0).otherwise(F.size(F.split(host, "[.]"))),
        "digit_ratio": digits / n,
        "host_digits": F.length(F.regexp_replace(host, "[^0-9]+", "")),
        "hyphens": F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit(""))),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.length(query),
        "has_fragment": F.instr(url, "#") > 0,
        "is_https": url.startswith("https://"),
        "ends_in_slash": path.endswith("/"),
        "has_extension": F.instr(last, ".") > 0,
        "has_www": host.startswith("www."),
        "entropy": entropy,
    }
    return {k: F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in found.items()}


SUFFIXES = {"suffix_1": 1, "suffix_2": 2}


def described(pages: DataFrame, url: str, keep: list[str], rules: list[PathRule] | DataFrame) -> tuple[DataFrame, list[str]]:
    """Columns ``keep``, ``_url``, ``host``, ``path``, ``rule``, ``verdict`` (null without rule) and the features, one of them each suffix's frequency."""
    df = pages.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("_url"))
    cut_host, cut_path = parts(F.col("_url"))
    df = df.select("*", cut_host.alias("host"), cut_path.alias("path"))
    features = lexical(F.col("_url"), F.col("host"), F.col("path"))
    suffix = {k: F.substring_index(F.col("host"), ".", -n) for k, n in SUFFIXES.items()}
    df = scratch(df.select("*", *[c.alias(k) for k, c in features.items()], *[c.alias(k) for k, c in suffix.items()]))
    for k in SUFFIXES:
        counts = scratch(df.groupBy(F.col(k).alias("_key")).agg(F.log1p(F.count("*").cast("double")).alias(f"{k}_frequency")))
        df = df.join(counts, F.col(k) == F.col("_key")).drop("_key", k)
    fit = scratch(ruled(df, rules))
    df = df.join(fit, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left").drop("_host", "_path")
    return df, [*features, *[f"{k}_frequency" for k in SUFFIXES]]


def train(labelled: DataFrame, features: list[str], label: str, trees: int = 20, depth: int = 4, seed: int = 7) -> PipelineModel | None:
    """Trees that tell ``label`` 1 from 0 (null rows are left out); None where the labels don't hold both."""
    rows = labelled.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("double").alias("_label"))
    if rows.agg(F.count_distinct("_label")).first()[0] < 2:
        return None
    ready = VectorAssembler(inputCols=features, outputCol="_features")
    trained = GBTClassifier(
        featuresCol="_features", labelCol="_label", predictionCol="_predicted", maxIter=trees, maxDepth=depth, maxBins=32, seed=seed
    )
    trained.setRawPredictionCol("_raw").setProbabilityCol("_chance")
    model = trained.fit(ready.transform(rows).select("_features", "_label"))
    return PipelineModel([ready, model])


def held_out(url: Column, part: int = 5) -> Column:
    """One URL in ``part``, all its rows alike: not trained on, but used to set the threshold and to tell how good the trees are."""
    return F.pmod(F.xxhash64(F.coalesce(url, F.lit("")), F.lit(11)), F.lit(part)) == 0


def _chance() -> Column:
    return vector_to_array("_chance")[1]


def tested(model: PipelineModel, held: DataFrame, label: str, steps: int = 100) -> tuple[float | None, float]:
    """Of labelled rows: the chance that one with label 1 scores above one with 0 (AUC), and the threshold with the best mean of both hit rates.

    Scores are counted in ``steps`` bins, so only these meet; without both labels there is no AUC and the threshold is one half.
    """
    scored = model.transform(held.where(F.col(label).isNotNull())).select(F.floor(_chance() * steps).cast("int").alias("at"), F.col(label).alias("label"))
    bins = scored.groupBy("at").agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))
    rows = sorted((r["at"], r["ones"], r["zeros"]) for r in bins.collect())  # at most ``steps`` + 1
    ones, zeros = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not ones or not zeros:
        return None, 0.5
    below, won, best, threshold = 0, 0.0, -1.0, 0.5
    missed = 0
    for at, one, zero in rows:
        hits = (ones - missed) / ones + below / zeros  # cut below this bin
        if hits > best:
            best, threshold = hits, at / steps
        won += one * (below + zero / 2)
        below, missed = below + zero, missed + one
    return won / (ones * zeros), threshold


def judge(
    pages: DataFrame, rules: list[PathRule] | DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), otherwise: str = "allow",
    labels: DataFrame | None = None, report: dict | None = None,
) -> DataFrame:
    """A row per URL: ``keep``, ``host``, ``path``, ``rule``, ``verdict``.

    The longest rule decides, see :func:`ruled`; the trees judge the others. They learn from ``labels`` (``url, block`` 0 or 1, a null not
    counting), or where these aren't given from the URLs that a rule decides. One labelled URL in five is held out of training and sets the
    threshold; ``report`` gets the ``auc`` on these and the ``threshold``. Without both kinds of labels ``otherwise`` stands for the trees. A null or
    malformed URL has an empty host and path and is judged by the trees. Repeated rows are judged alike, a URL with several labels counts as often;
    no rows give no rows; extra columns are ignored.
    """
    df, features = described(pages, url, list(keep), rules)
    if labels is None:
        df = df.withColumn("_block", (F.col("verdict") == "block").cast("double"))
        taught = df
    else:
        told = labels.select(F.coalesce("url", F.lit("")).alias("_url"), F.col("block").cast("double").alias("_block")).where("_block is not null")
        taught = scratch(df).dropDuplicates(["_url"]).join(told, "_url")
    df, taught = scratch(df), scratch(taught.select("_url", *features, "_block"))
    model = train(taught.where(~held_out(F.col("_url"))), features, "_block")
    if model is None:
        guess = F.lit(otherwise)
    else:
        auc, threshold = tested(model, taught.where(held_out(F.col("_url"))), "_block")
        if report is not None:
            report |= {"auc": auc, "threshold": threshold}
        df = model.transform(df)
        guess = F.when(_chance() >= threshold, "block").otherwise("allow")
    return df.select(*[F.col(f"`{c}`") for c in keep], "host", "path", "rule", F.coalesce("verdict", guess).alias("verdict"))
