import heapq
import random
from collections import Counter, defaultdict

import pytest
from llm_data import SMALL, odd_documents, read
from pyspark.sql import functions as F

from tidemark.llm import sharding


def lpt(sizes, shards):
    heap, taken = [(0, k) for k in range(shards)], Counter()
    for s in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        taken[s, k] += 1
        heapq.heappush(heap, (load + s, k))
    return taken


@pytest.mark.parametrize("seed", range(30))
def test_many_equal_sizes_at_once(seed):
    r = random.Random(seed)
    shards, sizes = r.randrange(1, 9), []
    for _ in range(r.randrange(1, 12)):
        sizes += [r.randrange(1, 500)] * r.choice([1, 2, 7, 100, 1000])
    heap, got = sharding.Shards(shards), Counter()
    for s, n in sorted(Counter(sizes).items(), reverse=True):
        for k, taken in enumerate(heap.take(s, n)):
            got[s, k] += taken
    assert +got == lpt(sizes, shards)


def checked(docs, rows, shards):
    assert [c for c in rows.columns if c in docs.columns] == docs.columns
    rows = rows.collect()
    assert len(rows) == docs.count()
    slots, where = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r[-2]].append((r[-1], r.doc_id))
        where[r.text or ""].add(r[-2])
    assert set(slots) <= set(range(shards)) and all(len(s) == 1 for s in where.values())
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
        ids = [d for _, d in sorted(found) if d is not None]
        assert ids == sorted(ids)
    return rows


def test_odd_rows_and_other_names(spark, odd, empty):
    checked(odd, sharding.shard(odd, shards=3), 3)
    named = odd_documents(spark).withColumn("shard", F.lit("mine")).withColumn("SLOT", F.lit("mine")).withColumn("doc", F.lit(1)).withColumn("group", F.lit(2)).withColumn("rank", F.lit(3))
    out = sharding.shard(named, shards=5)
    assert out.columns == [*named.columns, "shard_", "slot_"]
    checked(named, out, 5)
    assert sharding.shard(empty).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(odd, shards=0)


def test_own_groups_and_sizes(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 40).alias("g"), (F.col("id") % 7 + 1).alias("s"))
    rows = sharding.shard(docs.withColumn("g", F.when(F.col("g") > 0, F.col("g"))), size=F.col("s"), group=F.col("g"), shards=6).collect()
    shard_of, load = defaultdict(set), Counter()
    for r in rows:
        shard_of[r.g].add(r.shard)
        load[r.shard] += r.s
    assert all(len(s) == 1 for s in shard_of.values()) and max(load.values()) - min(load.values()) <= 8 * 7


def test_loads_are_those_of_the_plain_rule(spark):
    docs = read(spark, SMALL, "documents")
    rows = sharding.shard(docs, shards=7).select("text", "shard").collect()
    bytes_of, want, got = Counter(), Counter(), Counter()
    for r in rows:
        size = len((r.text or "").encode()) + 8
        bytes_of[r.text or ""] += size
        got[r.shard] += size
    for (s, k), n in lpt(bytes_of.values(), 7).items():
        want[k] += s * n
    assert got == want


def test_a_group_with_half_of_all_rows_spreads_its_slots(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("text"))
    checked(docs, sharding.shard(docs.repartition(9), shards=4), 4)
    one = sharding.placed(docs.select(F.lit(1).alias("k"), "doc_id"), "k", ["doc_id"], "at")
    assert one.where("at <> doc_id").count() == 0 and one.count() == 20_000


def test_layout_does_not_matter(spark):
    docs = read(spark, SMALL, "documents").select("doc_id", "text")
    one = sorted(map(str, sharding.shard(docs).collect()))
    assert one == sorted(map(str, sharding.shard(docs.repartition(11, F.rand(3))).collect()))


def test_written_shards(spark, tmp_path):
    docs = read(spark, SMALL, "documents")
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(*docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()
    assert sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2, 3]
