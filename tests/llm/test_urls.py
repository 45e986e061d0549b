import math

from llm_data import MIDDLE, odd_documents, read
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.llm import urls
from tidemark.llm.queries import URL_RULES

CASES = [
    ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/"), ("https://a.b.EXAMPLE.org/en/123?x=1", "a.b.example.org", "/en/123", "example.org/en/1"),
    ("https://example.org/en/2", "example.org", "/en/2", "org/"), ("https://notexample.org/es/", "notexample.org", "/es/", "org/"),
    ("https://org", "org", "", None), ("https://x.com/fr/a#f", "x.com", "/fr/a", "com/fr/"), ("https://com/de/", "com", "/de/", "com/de/"),
    ("https://x.com/FR/a", "x.com", "/FR/a", None), ("https://x.com.net/fr/", "x.com.net", "/fr/", None), ("no scheme.org/", "", "", None),
    ("http://a.org?u=http://b.com/fr/", "a.org", "", None), ("ftp://ÄÖ.Org/", "ÄÖ.org", "/", "org/"), ("", "", "", None), (None, "", "", None),
    ("x#y://h.org/p", "h.org", "/p", "org/"), ("https://h.org/a\nb", "h.org", "/a\nb", "org/"),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, URL_RULES).collect()}
    for i, (_, host, path, rule) in enumerate(CASES):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), CASES[i]
        assert got[i].verdict in ("allow", "block")
        if rule:
            assert got[i].verdict == {r.name: r.verdict for r in URL_RULES}[rule]


def test_features(spark):
    row = spark.createDataFrame([("https://www.a-b.org/x1/y.html?p=1&q=2#f",)], "url string")
    host, path = urls.parts(F.col("url"))
    r = row.select(*[c.alias(k) for k, c in urls.lexical(F.col("url"), host, path).items()]).first().asDict()
    text = "https://www.a-b.org/x1/y.html?p=1&q=2#f"
    assert (r["url_length"], r["depth"], r["parameters"], r["labels"], r["has_fragment"], r["has_extension"], r["hyphens"]) == (len(text), 2, 2, 3, 1, 1, 1)
    want = -sum(text.count(c) / len(text) * math.log2(text.count(c) / len(text)) for c in set(text))
    assert math.isclose(r["entropy"], want, rel_tol=1e-9)
    assert math.isclose(r["digit_ratio"], 3 / len(text))


def test_trees_learn_labelled_urls(spark):
    pages = read(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    digits = F.length(F.regexp_replace("url", "[^0-9]", "")) > 4
    df, features = urls.described(pages, "url", ["page_id"], [])
    df = df.join(pages.select("page_id", digits.cast("int").alias("label")), "page_id")
    held = F.crc32(F.col("page_id").cast("string").cast("binary")) % 4 == 2
    model = urls.train(df.where(~held), features, "label")
    assert model.transform(df.where(held)).agg(F.avg((F.col("_predicted") == F.col("label")).cast("double"))).first()[0] > 0.95


def test_odd_and_empty(spark):
    pages = odd_documents(spark).select("doc_id", F.col("text").alias("url"), "class")
    got = urls.judge(pages, URL_RULES, keep=("doc_id",))
    assert got.count() == pages.count() and got.where("verdict <> 'allow'").count() == 0  # no rule fits, so nothing to learn from
    assert urls.judge(pages.limit(0), URL_RULES, keep=("doc_id",)).count() == 0
    twice = read(spark, MIDDLE, "pages")
    found = urls.judge(twice.unionByName(twice), URL_RULES)
    assert found.count() == 2 * twice.count() and found.distinct().count() == twice.count()


def test_given_labels_are_held_out_in_part(spark):
    pages = read(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    block = (F.length(F.regexp_replace("url", "[^0-9]", "")) > 4).cast("int")
    labels = pages.select("url", block.alias("block")).distinct()
    report = {}
    got = urls.judge(pages, [urls.PathRule("allow", "org", "/")], labels=labels, report=report)
    assert report["auc"] > 0.95 and 0 < report["threshold"] < 1
    right = got.join(pages.withColumn("block", block), "page_id").where("rule is null").agg(F.avg(((F.col("verdict") == "block") == (F.col("block") == 1)).cast("double"))).first()[0]
    assert right > 0.95 and got.where("rule = 'org/' and verdict <> 'allow'").count() == 0


def test_auc_counts_ties_as_half(spark):
    class Fixed:
        def transform(self, df):
            return df.withColumn("_chance", array_to_vector(F.array(1 - F.col("p"), F.col("p"))))

    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 0), (0.5, None)]
    auc, threshold = urls.tested(Fixed(), spark.createDataFrame(rows, "p double, y int"), "y")
    assert math.isclose(auc, 5.5 / 6) and 0.3 < threshold <= 0.8
    assert urls.tested(Fixed(), spark.createDataFrame(rows[:1], "p double, y int"), "y") == (None, 0.5)


def test_many_rules_meet_by_host(spark):
    rules = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, "block").otherwise("allow").alias("verdict"), F.concat(F.lit("h"), F.col("id") % 50_000, F.lit(".net")).alias("host"),
        F.when(F.col("id") < 50_000, "/").otherwise("/a/").alias("path"))
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://www.h"), F.col("id") * 31, F.lit(".net/"), F.when(F.col("id") % 3 == 0, "a/x").otherwise("b")).alias("url"))
    host, path = urls.parts(F.col("url"))
    found = {(r._host, r._path): r.rule for r in urls.ruled(pages.select(host.alias("host"), path.alias("path")), rules).collect()}
    for r in pages.select(host.alias("host"), path.alias("path")).collect():
        own = r.host.removeprefix("www.")
        assert found.get((r.host, r.path)) == (own + ("/a/" if r.path.startswith("/a/") else "/") if int(own[1:-4]) < 50_000 else None)
