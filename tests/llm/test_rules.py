import math
import re
from collections import Counter

from llm_data import SMALL, read
from pyspark.sql import functions as F

from tidemark.llm import rules


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    often = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if often[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def counts(df):
    return sorted(map(str, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect())))


def test_counts_equal_brute_force(spark, odd):
    labels = read(spark, SMALL, "labels")
    for docs in (odd, read(spark, SMALL, "documents")):
        judged = rules.quality(docs, labels)
        assert counts(judged) == sorted(map(str, ((r.doc_id, *brute(r.text)) for r in docs.collect())))
        for r in judged.collect():
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and not r.rejected_by)


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 5, 9, 40, 400, 3000) for k in (0, 1, 3, 7, 25) if k <= n]
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in got:
        want = math.fsum(math.comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == 1.0 if r.k >= r.n * 0.01 else math.isclose(r.p, want, rel_tol=1e-9)


def held(spark, n_good, n_odd, n_bad, stratum):
    """Good rows of few symbols, ``n_odd`` of them like the bad ones."""
    zero = {c: 0 for c in rules.STATS} | {"n_words": 100, "word_chars": 500, "n_lines": 5, "stratum": stratum}
    rows = [zero | {"good": True, "n_symbols": 300 if i < n_odd else 0} for i in range(n_good)] + [zero | {"good": False, "n_symbols": 300}] * n_bad
    return spark.createDataFrame(rows)


def test_cutoffs_need_proof(spark):
    one = rules.Rule("symbols", True, "n_symbols", "n_words", (2.0, 0.5))
    # P(X = 0) = 0.99 ** n <= 0.05 / (2 cutoffs * 3 strata) needs n >= 477; two rejected good ones of 1200 pass, nine don't
    data = held(spark, 477, 0, 20, "a").unionByName(held(spark, 476, 0, 20, "b")).unionByName(held(spark, 1200, 9, 20, "c"))
    chosen = {r.stratum: r.cutoffs for r in rules.choose(data, rules=(one,), risk=0.01).collect()}
    assert chosen == {"a": {0: 2}} or chosen == {"a": {0: 1}}
    data = held(spark, 1200, 2, 20, "a")
    assert rules.choose(data, rules=(one,), risk=0.01).count() == 1
    assert rules.choose(data.limit(0), rules=(one,)).count() == 0


def test_rules_share_the_risk_of_a_stratum(spark):
    """Each of four rules alone could reject 1 % of the good documents; together they are held to 1 %."""
    four = tuple(rules.Rule(f"r{k}", True, c, "n_words", (0.5,)) for k, c in enumerate(("n_symbols", "n_dup_lines", "n_capitals", "n_exclamations")))
    zero = {c: 0 for c in rules.STATS} | {"n_words": 100, "word_chars": 500, "n_lines": 5, "stratum": "a"}
    lost = [{four[k % 4].top: 90} for k in range(48)]  # 0.6 % for each rule, 2.4 % for all
    data = spark.createDataFrame([zero | {"good": True} | x for x in lost + [{}] * 1952] + [zero | {"good": False} | {r.top: 90 for r in four}] * 50)
    assert rules.choose(data, rules=four, risk=0.01).count() == 0
    assert len(rules.choose(data, rules=four, risk=0.05).first().cutoffs) == 4


def test_rejection_on_check_tables_holds_its_promise(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    risk = 0.03 * len(rules.RULES)  # of a stratum, all rules together
    judged = rules.quality(docs, labels, risk=risk).join(labels, "doc_id").where("not base_failed")
    shares = judged.where("quality = 1").groupBy("stratum").agg(F.avg((~F.col("kept")).cast("double")).alias("lost"), F.count("*").alias("n")).collect()
    assert all(r.lost <= risk for r in shares)
    assert judged.where("quality = 0 and not kept").count() > 0.5 * judged.where("quality = 0").count()
    assert rules.quality(empty, labels).count() == 0
    assert rules.quality(docs.limit(20), labels.limit(0)).where("kept = base_failed").count() == 0
