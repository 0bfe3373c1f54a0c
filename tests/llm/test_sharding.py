import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wavefold.llm import queries, sharding

SF001 = "/root/testdata/sf0.001"


def check(rows, texts, shards):
    """Law ``rows``, gapless slots, sizes and CRCs; returns how many shards each text is in beyond the fewest."""
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) == len(texts) and max(sizes) - min(sizes) <= 1
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr) == want
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    room = -(-len(rows) // shards)
    n = Counter(r.text_crc32 for r in rows)
    return sum(len(h) - -(-n[c] // room) for c, h in homes.items())


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = queries.op2_sharding(spark, SF001).collect()
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert check(rows, texts, 16) <= 15


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_hot_group_ties_and_nulls(spark, shards):
    texts = [(i, "hot") for i in range(100)] + [(1000 + i, f"pair {i // 2}") for i in range(120)]
    texts += [(2000 + i, f"alone {i}") for i in range(60)] + [(None, None), (5, None), (5, ""), (5, ""), (6, "é" * 100_000)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, shard="clash", row=1, key=2) for d, t in texts])
    rows = sharding.shard(df, shards).collect()
    assert check(rows, texts, shards) <= shards


def test_labels_draw_links_together(spark):
    rows = spark.range(4000).select(F.col("id").alias("row"), F.when(F.col("id") < 3000, F.col("id") % 300)
                                    .otherwise(F.col("id")).alias("key"))
    cut = lambda df: df.filter("linked").groupBy("key").agg(F.countDistinct("label").alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
    before, after = (cut(sharding.propagate(rows, 8, rounds=k)) for k in (0, 5))
    assert after < before / 10
    sizes = [r["count"] for r in sharding.propagate(rows, 8, rounds=5).filter("linked").groupBy("label").count().collect()]
    assert max(sizes) <= 1.1 * 4000 / 8


def test_fewer_rows_than_shards_and_empty(spark):
    few = spark.createDataFrame([Row(doc_id=i, text="t") for i in range(3)])
    check(sharding.shard(few, 16).collect(), [(i, "t") for i in range(3)], 16)
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), 16).collect() == []


@pytest.mark.parametrize("shape", ["hot third", "pairs", "copies"])
def test_no_key_below_a_room_is_cut(spark, shape):
    n = 50_000
    key = {"hot third": "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN id div 12 ELSE id END",
           "pairs": "CASE WHEN id % 10 < 7 THEN (id div 10) * 10 + (id % 10) div 2 ELSE -id END",
           "copies": "0"}[shape]
    df = spark.range(n).selectExpr("id AS doc_id", f"cast({key} AS string) AS text")
    rows = sharding.shard(df, 16).collect()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    # copies must be cut, but never over more shards than they fill
    assert check(rows, texts, 16) == 0


def test_keys_find_the_rooms_that_are_left(spark):
    # no unlinked row to fill up with, large keys among small ones
    df = spark.range(48_000).selectExpr(
        "id AS doc_id", "cast(CASE WHEN id < 24000 THEN id div 1500 WHEN id < 36000 THEN 100000 + id div 100 "
        "ELSE 200000 + id div 2 END AS string) AS text")
    rows = sharding.shard(df, 16).collect()
    assert check(rows, [(r.doc_id, r.text) for r in df.collect()], 16) == 0


@pytest.mark.parametrize("sizes", [[7, 7, 6, 6, 5, 5, 4, 4, 3, 3, 2, 2], [13, 9, 8, 8, 7, 3, 3, 2], [40, 5, 5, 4, 2], [10, 10, 10, 10, 10]])
def test_as_few_cut_keys_as_possible(spark, sizes):
    free = 10
    texts = [(100 * k + i, f"key {k}") for k, n in enumerate(sizes) for i in range(n)] + [(9000 + i, f"alone {i}") for i in range(free)]
    rows = sharding.shard(spark.createDataFrame([Row(doc_id=d, text=t) for d, t in texts]), 4).collect()
    check(rows, texts, 4)
    homes = defaultdict(set)
    for r in rows:
        homes[r.text_crc32].add(r.shard)
    total = len(texts)
    rooms = [-(-(s + 1) * total // 4) - -(-s * total // 4) for s in range(4)]

    def fewest(at, left):
        # every way to put each key whole into a shard or to cut it
        if at == len(sizes):
            return 0
        return min([1 + fewest(at + 1, left)] + [
            fewest(at + 1, (*left[:s], left[s] - sizes[at], *left[s + 1:])) for s in range(4) if left[s] >= sizes[at]])

    assert sum(len(h) > 1 for h in homes.values()) == fewest(0, tuple(rooms))


def test_layout_does_not_matter(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (5, None), (5, "x"), (5, "x"), (None, "x")], "doc_id long, text string")
    docs = docs.union(odd)
    wanted = Counter(sharding.shard(docs, 16).select("doc_id", "size", "text_crc32", "shard", "slot").collect())
    for other in (docs.repartition(5), docs.orderBy(F.desc("doc_id")).coalesce(1)):
        assert Counter(sharding.shard(other, 16).select("doc_id", "size", "text_crc32", "shard", "slot").collect()) == wanted


def test_rounds_place_the_keys_of_small_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("row"), F.xxhash64("text").alias("key"))
    homes, rooms = sharding._place(docs, 16, None)
    found = homes.collect()
    assert found and all(r.home is not None for r in found) and not rooms.cut
