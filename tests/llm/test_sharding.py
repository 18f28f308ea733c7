"""Shards against plain longest-processing-time scheduling."""

import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest
from clickmill.llm import common, sharding
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_loads(weights, shards):
    heap = [(0, j) for j in range(shards)]
    for weight in sorted(weights, reverse=True):
        load, j = heapq.heappop(heap)
        heapq.heappush(heap, (load + weight, j))
    return [load for load, _ in sorted(heap, key=lambda x: x[1])]


def held_against_plain_version(rows, texts, shards):
    """rows (size, shard, slot, text_crc32) of documents with these texts."""
    weights, loads, slots, where = Counter(), [0] * shards, defaultdict(list), defaultdict(set)
    for text in texts:
        weights[text or ""] += len((text or "").encode()) + 1
    for r in rows:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[r.text_crc32, r["size"]].add(r.shard)
    assert loads == plain_loads(weights.values(), shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in where.values())
    assert Counter((zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for t in texts) == Counter(
        (r.text_crc32, r["size"]) for r in rows
    )


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_cycles_are_what_a_heap_gives(shards):
    draw = random.Random(shards)
    for _ in range(60):
        sizes = [(s, draw.choice([1, 2, 17, 500])) for s in draw.sample(range(1, 60), draw.randint(0, 12))]
        sizes += [(draw.choice([100, 900, 5000]), 1)]
        got = [0] * shards
        starts = defaultdict(list)
        for size, first, cycle in sharding.schedule(sizes, shards):
            assert len(set(cycle)) == len(cycle)
            starts[size].append((first, cycle))
        for size, count in sizes:
            for rank in range(count):
                first, cycle = max(x for x in starts[size] if x[0] <= rank)
                got[cycle[(rank - first) % len(cycle)]] += size
        assert got == plain_loads([s for s, n in sizes for _ in range(n)], shards)
        assert sum(map(len, starts.values())) <= 2 * shards * len(sizes)


def test_a_frequent_size_is_a_few_cycles():
    assert len(list(sharding.schedule([(7, 10**12), (10**13, 1)], 16))) < 40


def test_query_equals_plain_version(spark):
    texts = [r.text for r in common.documents(spark, SF).collect()]
    got = sharding.op11_sharding(spark, SF)
    assert dict(got.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int"}
    held_against_plain_version(got.collect(), texts, 16)


def test_groups_ranks_and_slots_over_many_tasks(spark, docs, monkeypatch):
    draw = random.Random(1)
    texts = [draw.choice(["a", "bb", "ccc", "é", ""]) * draw.randint(0, 3) + str(draw.randint(0, 60)) for _ in range(700)]
    texts += ["copied text"] * 350 + [None] * 9
    rows = docs([(draw.randint(0, 50), t) for t in texts]).repartition(7)
    rows = rows.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held_against_plain_version(sharding.shard(rows, 5, ["doc_id", "text_crc32"]).collect(), texts, 5)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows_empty_table_and_clashing_names(spark, odd, folder):
    texts = [r.text for r in odd.collect()]
    marked = odd.withColumns({
        **{c: F.lit("own") for c in ("row", "key", "task", "at", "shard", "first", "turn", "weight", "a.b")},
        "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
    })
    out = sharding.shard(marked, 4)
    assert out.columns == [c for c in marked.columns if c != "shard"] + ["size", "shard", "slot"]
    held_against_plain_version(out.collect(), texts, 4)
    assert {r.key for r in out.collect()} == {"own"}
    assert sharding.shard(odd.limit(0), 4).count() == 0
    sharding.write_shards(odd, folder + "/shards", 4)
    again = spark.read.parquet(folder + "/shards")
    assert sorted(map(str, (r.text for r in again.collect()))) == sorted(map(str, texts))
