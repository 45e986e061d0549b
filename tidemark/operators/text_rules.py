"""Classification by ordered rules, URLs, masking, mentions and search in text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mail providers whose addresses are personal.
PERSONAL_DOMAINS = ("gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "icloud.com", "aol.com", "live.com", "msn.com",
                    "mail.ru", "qq.com", "163.com", "protonmail.com", "gmx.de", "gmx.net", "web.de", "yandex.ru")


def rule_condition(kind: str, x: Column, arg) -> Column:
    if kind == "eq":
        return x == arg
    if kind == "in":
        return x.isin(*arg)
    if kind == "like":
        return x.like(arg)
    if kind == "like_any":
        cond = x.like(arg[0])
        for p in arg[1:]:
            cond = cond | x.like(p)
        return cond
    if kind == "regex":
        return x.rlike(arg)
    raise ValueError(kind)


def classify(df: DataFrame, rules: Sequence[tuple[str, str, object, str]], default: str, name: str) -> DataFrame:
    """Label of the first rule (column, kind, argument, label) that holds; one expression, no join."""
    out = F.when(F.lit(False), F.lit(default))
    for col, kind, arg, label in rules:
        out = out.when(rule_condition(kind, F.col(col), arg), F.lit(label))
    return df.withColumn(name, out.otherwise(F.lit(default)))


def classify_by_table(df: DataFrame, key: str, x: str, rules: DataFrame, default: str, name: str) -> DataFrame:
    """Label by a rule table (priority, word, label) too long for one expression: the words of the text are looked up.

    Each text is split into its distinct words, which are matched by equality, and the smallest priority wins; so the
    rule table may grow without comparing every text with every rule.
    """
    words = df.select(key, F.explode(F.array_distinct(F.split(F.lower(x), r"\W+"))).alias("word"))
    best = words.join(rules, "word").groupBy(key).agg(F.min_by("label", "priority").alias(name))
    return df.join(best, key, "left").withColumn(name, F.coalesce(name, F.lit(default)))


def mask_when(df: DataFrame, rules: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Replace a column's value by a mask in the rows its condition selects."""
    return df.withColumns({col: F.when(cond, F.lit(mask)).otherwise(F.col(col)) for col, (cond, mask) in rules.items()})


def url_parameter(url: Column, name: str) -> Column:
    """Value of a query parameter, NULL when absent."""
    return F.nullif(F.regexp_extract(url, f"[?&]{name}=([^&#]*)", 1), F.lit(""))


def clean_url(url: Column) -> Column:
    """Path of a URL without scheme, host, query, fragment, ids and trailing slash."""
    path = F.regexp_replace(url, r"^[a-zA-Z]+://[^/?#]*|[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(F.lower(path), r"/[0-9]+(?=/|$)", "/:id"), r"/+$", "")


def url_parts(df: DataFrame, url: str) -> DataFrame:
    return df.select("*", F.try_parse_url(url, F.lit("PROTOCOL")).alias("url_scheme"), F.try_parse_url(url, F.lit("HOST")).alias("url_host"),
                     F.try_parse_url(url, F.lit("PATH")).alias("url_path"), F.try_parse_url(url, F.lit("QUERY")).alias("url_query"),
                     F.try_parse_url(url, F.lit("REF")).alias("url_fragment"), clean_url(F.col(url)).alias("clean_path"))


def slugify(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"))


def campaign_parts(code: Column, names: Sequence[str], sep: str = "_") -> list[Column]:
    """Typed parts of a campaign code."""
    return [F.get(F.split(code, sep), F.lit(k)).alias(n) for k, n in enumerate(names)]


def email_domain_type(domain: Column, source: Column, bulk_sources: Sequence[str], personal: Sequence[str] = PERSONAL_DOMAINS) -> Column:
    d = F.lower(F.trim(domain))
    return (F.when(source.isin(*bulk_sources), "Bulk load").when(d.isNull() | (d == ""), "Missing")
            .when(d.isin(*personal), "Personal").otherwise("Business"))


def mentions(df: DataFrame, keys: Sequence[str], text: str, pattern: str, group: int = 0, name: str = "mention") -> DataFrame:
    """All matches of a pattern, one row each."""
    return df.select(*keys, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias(name))


def net_mentions(added: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mentions that were added and not taken back: those with one kind of action only."""
    a = added.select(*keys, F.lit("add").alias("action"))
    r = removed.select(*keys, F.lit("remove").alias("action"))
    g = a.unionByName(r).groupBy(*keys).agg(F.min("action").alias("lo"), F.max("action").alias("hi"))
    return g.where((F.col("lo") == "add") & (F.col("hi") == "add")).select(*keys)


def find_definition(df: DataFrame, path: str, text: str, pattern: str) -> DataFrame:
    """Lines of a corpus that match a pattern, with their path and 1-based line number."""
    lines = df.where(F.col(text).rlike(pattern)).select(path, F.posexplode(F.split(text, "\n")).alias("__p", "line"))
    return lines.where(F.col("line").rlike(pattern)).select(path, (F.col("__p") + 1).alias("line_number"), "line")
