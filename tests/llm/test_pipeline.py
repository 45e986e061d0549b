"""Each stage against brute force on what it received."""

import corpus_pipeline
from llm_data import MIDDLE, odd_documents, read
from pyspark.sql import functions as F
from test_decontaminate import brute as hits
from test_jaccard import brute as links
from test_lines import brute as stripped

from tidemark.llm.common import scratch


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark):
    docs = read(spark, MIDDLE, "documents")
    at, seen = docs, [docs]
    for _, stage in corpus_pipeline.STAGES:
        at = scratch(stage(spark, at, MIDDLE))
        seen.append(at)
    source, good, lines, single, clean, mixed = seen
    assert all(x.columns == docs.columns for x in seen[:-1]) and mixed.columns == [*docs.columns, "copy"]

    labels = read(spark, MIDDLE, "labels")
    assert good.exceptAll(source).count() == 0
    assert source.join(good, "doc_id", "left_anti").join(labels, "doc_id").where("quality = 1").count() <= 5
    assert good.join(labels, "doc_id").where("quality = 0").count() <= 3

    assert sorted(pairs(lines)) == [(i, t) for i, _, _, t in stripped(pairs(good))]
    assert lines.where(F.col("n_chars") != F.length("text")).count() == 0

    classes = {c for _, c, _ in map(eval, links(pairs(lines)))}
    assert {r.doc_id for r in single.select("doc_id").collect()} == classes and single.exceptAll(lines).count() == 0

    items = [tuple(r) for r in read(spark, MIDDLE, "benchmark").collect()]
    left = {i for i, _, h, _ in map(eval, hits(pairs(single), items, 10)) if not h}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == left and clean.exceptAll(single).count() == 0

    taken = mixed.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("top"))
    assert taken.where("n > 2 or n <> top").count() == 0 and mixed.drop("copy").distinct().exceptAll(clean).count() == 0
    words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    have, got = (x.agg(F.sum(words)).first()[0] for x in (clean, mixed))
    assert 1.4 < got / have < 1.6


def test_stages_take_odd_rows(spark, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "size", "copy"]
    odd = odd_documents(spark).withColumn("n_chars", F.length("text").cast("long")).withColumn("copy", F.lit(1)).select(*columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (odd, odd.limit(0)):
            assert stage(spark, rows, MIDDLE).columns == columns
            stage(spark, rows, MIDDLE).write.format("noop").mode("overwrite").save()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, MIDDLE).columns == [*columns, "copy_"]
