from llm_data import MIDDLE, odd_documents, read
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.common import n_words


def reshared(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Dealing the excess of full sources anew until none is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, left, still = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and still:
        each = left / sum(w[s] for s in still)
        full = {s for s in still if target[s] + each * w[s] > most * sizes[s] + 1e-12}
        if not full:
            for s in still:
                target[s] += each * w[s]
            return target
        for s in full:  # fix them at their bound and start the others afresh
            target[s] = most * sizes[s]
        still -= full
        left = share * sum(sizes.values()) - sum(target[s] for s in names if s not in still)
        for s in still:
            target[s] = 0.0
    return target


def dealt(docs):
    return mixing.copies(docs, n_words(F.col("text"))).select("row.doc_id", "row.source", "size", "source_size", "target", "copies")


def test_targets_and_words_taken(spark, odd):
    for docs in (read(spark, MIDDLE, "documents"), odd):
        rows = dealt(docs).collect()
        sizes, taken, most = {}, {}, {}
        for r in rows:
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
            taken[r.source] = taken.get(r.source, 0) + r["size"] * r.copies
            most[r.source] = max(most.get(r.source, 0), r["size"])
            assert 0 <= r.copies <= 2
        want = reshared(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        for s, t in want.items():
            assert abs(taken[s] - t) <= 2 * most[s]


def test_layout_does_not_matter(spark):
    docs = read(spark, MIDDLE, "documents")
    one = sorted(map(str, dealt(docs).collect()))
    other = sorted(map(str, dealt(docs.repartition(13, "text").orderBy(F.rand(5))).collect()))
    assert one == other


def test_mix_repeats_whole_rows(spark, odd, empty):
    mixed = mixing.mix(odd)
    assert mixed.columns == [*odd.columns, "copy"] and mixing.mix(empty).count() == 0
    wanted = sum(r.copies for r in dealt(odd).collect())
    assert mixed.count() == wanted
    docs = odd_documents(spark).withColumn("copy", F.lit("mine"))
    assert mixing.mix(docs).columns == [*docs.columns, "copy_"]


def test_sources_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.copies) for r in dealt(docs).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
