"""Covers of intervals, and joins along their cells."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import finance, intervals


def cells_of(spark, bounds, bits):
    df = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(bounds)], "n int, a long, b long")
    return {r.n: [(c.level, c.cell) for c in r.c] for r in df.select("n", intervals.cover(F.col("a"), F.col("b"), bits).alias("c")).collect()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-300, 300), st.integers(-20, 400)), min_size=1, max_size=30), st.sampled_from([1, 2, 3, 8]))
def test_cover_is_exact_and_small(spark, spans, bits):
    bounds = [(a, a + n) for a, n in spans]
    for n, cells in cells_of(spark, bounds, bits).items():
        a, b = bounds[n]
        held = [x for level, cell in cells for x in range(cell << bits * level, (cell + 1) << bits * level)]
        assert sorted(held) == list(range(a, b + 1))  # each number once
        if b >= a:
            size = b - a + 1
            assert len(cells) <= 2 * ((1 << bits) - 1) * ((size.bit_length() - 1) // bits + 1)


def test_long_intervals_have_few_cells(spark):
    year, life, none = cells_of(spark, [(5, 5 + 8759), (-(2**40) + 7, 2**61 + 12345), (9, 3)], 1).values()
    assert len(year) <= 26 and len(life) <= 2 * 62 and none == []


@pytest.mark.parametrize("bits", [1, 3])
def test_joins_equal_all_pairs(spark, bits):
    r = random.Random(bits)
    span = lambda n, k: [(k * 1000 + i, r.choice([1, 1, 1, 2, None]), (a := r.randrange(-500, 500)), a + r.choice([0, 1, 5, 300, -3])) for i in range(n)]
    a, b = span(120, 1), span(90, 2)
    da = spark.createDataFrame(a, "ida int, k int, a1 long, a2 long")
    db = spark.createDataFrame(b, "idb int, k int, b1 long, b2 long")
    col = F.col
    got = [(x.ida, x.idb) for x in intervals.overlaps(da, db, ["k"], (col("a1"), col("a2")), (col("b1"), col("b2")), bits).collect()]
    want = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] is not None and max(x[2], y[2]) <= min(x[3], y[3]) and x[2] <= x[3] and y[2] <= y[3]]
    assert len(got) == len(set(got)) and set(got) == set(want)
    got = [(x.ida, x.idb) for x in intervals.points_in(da, db, ["k"], col("a1"), col("b1"), col("b2"), bits).collect()]
    want = [(x[0], y[0]) for x in a for y in b if x[1] == y[1] is not None and y[2] <= x[2] <= y[3]]
    assert sorted(got) == sorted(want)
    semi = intervals.points_in(da, db, ["k"], col("a1"), col("b1"), col("b2"), bits, "left_semi")
    assert sorted(x.ida for x in semi.collect()) == sorted({x for x, _ in want}) and semi.columns == da.columns


def test_a_year_long_statement_is_not_cut_into_hours(spark):
    one = spark.sql("SELECT 1 AS k, 7 AS id, timestamp_ntz'2023-01-01 00:10:00' AS start, timestamp_ntz'2023-12-31 23:00:00' AS end")
    cells = one.select(F.size(intervals.cover(F.floor(F.unix_seconds(F.col("start").cast("timestamp")) / 3600), F.floor(F.unix_seconds(F.col("end").cast("timestamp")) / 3600)))).first()[0]
    assert cells <= 26
    meters = spark.range(8760).select(F.lit(1).alias("k"), (F.lit(2.0)).alias("credits"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.expr("timestamp_ntz'2023-01-01 00:00:00'")).alias("start"))
    meters = meters.withColumn("end", F.timestamp_add("HOUR", F.lit(1), F.col("start")))
    out = finance.overlap_attribution(one, meters, "k", "id", "credits")
    assert out.count() == 8759 and abs(out.agg(F.sum("attributed")).first()[0] - 2.0 * 8759) < 1e-6


def test_address_ranges(spark):
    ranges = spark.createDataFrame([(0, 255, "a"), (256, 2**24 + 5, "b"), (2**31, 2**32 - 1, "c"), (2**31 + 7, 2**31 + 7, "d")], "f long, l long, region string")
    ips = spark.createDataFrame([(x,) for x in (0, 255, 256, 2**24 + 5, 2**24 + 6, 2**31 + 7, 2**32 - 1)], "n long")
    got = sorted((r.n, r.region) for r in finance.ip_to_region(ips, "n", ranges, "f", "l").collect())
    assert got == [(0, "a"), (255, "a"), (256, "b"), (2**24 + 5, "b"), (2**31 + 7, "c"), (2**31 + 7, "d"), (2**32 - 1, "c")]
