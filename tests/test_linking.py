"""One-to-one links, exact distinct counts by bitmaps, sketches."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bitmaps, linking, sketches, usage


def brute(pairs):
    used_l, used_r, out = set(), set(), set()
    for _, l, r in sorted((c, l, r) for l, r, c in pairs):  # noqa: E741
        if l not in used_l and r not in used_r:
            used_l.add(l), used_r.add(r), out.add((l, r))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_links_are_those_of_the_sorted_pass(spark, seed):
    r = random.Random(seed)
    pairs = {(r.randrange(60), r.randrange(40)): r.randrange(6) for _ in range(500)}
    rows = [(a, b, c) for (a, b), c in pairs.items()]
    df = spark.createDataFrame([*rows, (None, 3, 0), (4, None, 0)], "a long, b long, c int")
    got = [(x.a, x.b) for x in linking.one_to_one(df, "a", "b", [F.col("c")]).collect()]
    assert len({b for _, b in got}) == len(got) == len({a for a, _ in got}) and set(got) == brute(rows)


def test_chain_of_preferences(spark):
    rows = [x for i in range(40) for x in ((i, i, 2 * i + 1), (i, i + 1, 2 * i))]  # each wants the next one's first choice
    got = {(x.a, x.b) for x in linking.one_to_one(spark.createDataFrame(rows, "a long, b long, c int"), "a", "b", [F.col("c")]).collect()}
    assert got == brute(rows)
    assert linking.one_to_one(spark.createDataFrame([], "a long, b long, c int"), "a", "b", [F.col("c")]).count() == 0


def test_evidence(spark):
    left = spark.createDataFrame([(1, "x", 10.0, 1500), (2, "x", 20.004, 15), (3, "y", 10.0, 7)], "id int, k string, amount double, quantity long")
    right = spark.createDataFrame([(11, "x", 10.0, "deal"), (12, "x", 99.0, "for 1,500 seats"), (13, "x", 20.0, "15 of 1500"), (14, "y", 5.0, "17 seats"), (15, "y", None, None)],
                                  "rid int, k string, deal double, name string")
    got = {(r.id, r.rid): r.points for r in linking.amount_and_quantity(left, right, ["k"], "amount", "quantity", "deal", "name").collect()}
    assert got == {(1, 11): 5, (1, 12): 6, (1, 13): 5, (2, 13): 11}


def test_unions_of_bitmaps_are_exact(spark):
    r = random.Random(3)
    rows = [(r.choice("abc"), r.randrange(5), f"u{r.randrange(90_000)}") for _ in range(60_000)]
    df = spark.createDataFrame([*rows, ("a", 1, None)], "g string, d int, u string")
    n = bitmaps.numbers(df, "u")
    ids = sorted({u for _, _, u in rows})
    assert {x.u: x.number for x in n.collect()} == {u: k for k, u in enumerate(ids, 1)}
    table = bitmaps.table(bitmaps.numbered(df, "u"), ["g", "d"], "number")
    assert table.groupBy("g", "d").count().agg(F.max("count")).first()[0] == 2  # 32,768 ids a bitmap
    for keys in (["g"], ["d"], ["g", "d"], []):
        want = {tuple(x)[:-1]: x[-1] for x in df.groupBy(*keys).agg(F.countDistinct("u")).collect()}
        assert {tuple(x)[:-1]: x[-1] for x in bitmaps.counted(table, keys, "n").collect()} == want


def test_trailing_windows(spark):
    r = random.Random(4)
    e = spark.createDataFrame([(r.choice("ab"), r.randrange(300), r.randrange(60), float(r.randrange(1000))) for _ in range(4000)], "k string, u long, off int, v double")
    e = e.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("off") * (1 + F.col("off") % 3)))
    rows = [(x.k, x.u, x.day) for x in e.collect()]
    got = {(x.k, x.day): x.active_users for x in usage.trailing_active_users(e, ["k"], "u", "day", 7).collect()}
    want = {(k, d): len({u for k2, u, d2 in rows if k2 == k and 0 <= (d - d2).days < 7}) for k, _, d in rows}
    assert got == want
    near = sketches.trailing(sketches.daily(e, ["k"], "day", "u", "v"), ["k"], "day", 7, {"m": 0.5}).collect()
    assert {(x.k, x.day) for x in near} == set(want) and all(x.days <= 7 for x in near)
    assert all(abs(x.items_estimate - want[x.k, x.day]) <= 1 + 0.041 * want[x.k, x.day] for x in near)
