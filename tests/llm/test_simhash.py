import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from wavefold.llm import queries, simhash

SF001 = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, k=3, bits=2):
    fps = [plain_fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def collected(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_fingerprint_matches_plain():
    for text in ["", None, "   \n", "One", "one TWO", "a b c", "A b  c\td\ne É é", "x " * 500, "ß\x0bÄ\x1cb"]:
        assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stars_hold_all_links_together(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    near = np.concatenate([base, *(base[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) for _ in range(12))])
    points = np.unique(near)
    a, b = simhash.stars(points, 2)
    root = {int(p): int(p) for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[max(find(x), find(y))] = min(find(x), find(y))
    got = {int(p): find(int(p)) for p in points}
    root = {int(p): int(p) for p in points}
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[:i] ^ points[i]) <= 2):
            x, y = find(int(points[i])), find(int(points[j]))
            root[max(x, y)] = min(x, y)
    assert got == {int(p): find(int(p)) for p in points}
    assert len(a) <= 12 * len(points)


def test_every_link_shares_a_leaf():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    other = points ^ (np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64))
    tree = simhash.VantageTree(points[:1000], 4000, 2, 100)
    assert tree.leaves > 8
    home = [set() for _ in points]
    for leaf, at in tree.leaves_of(points):
        for i in at:
            home[i].add(leaf)
    shared = [False] * len(points)
    for leaf, at in tree.leaves_of(other):
        for i in at:
            shared[i] |= leaf in home[i]
    assert all(shared)


def test_chain_is_one_component(spark):
    rows = [Row(a=i + 1, b=i) for i in range(60)] + [Row(a=101, b=100), Row(a=100, b=101)]
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame(rows)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert collected(queries.op7_simhash(spark, SF001)) == plain_components(rows)


def test_edges_and_small_shards(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(50)]
    rows = [(None, "one two three four"), (1, None), (2, ""), (3, " \n"), (9, "same text here now"), (9, "same text here now"),
            (8, "Same TEXT here now"), (4, "x" * 100_000)]
    for i in range(20, 220):
        base = rng.choice(words, 40).tolist() if i % 4 == 0 else base
        rows.append((i, " ".join(base if i % 4 else [*base, "tail"])))
    df = spark.createDataFrame([Row(doc_id=d, text=t, fp="clash", shard=1) for d, t in rows])
    got = simhash.near_duplicates(df, shard_points=16)
    assert collected(got) == plain_components(rows)
    kept = simhash.keep_first(df, shard_points=16)
    assert kept.columns == df.columns
    want = {c for _, _, c in plain_components(rows) if c is not None}
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_first(df).collect() == []


def _linked(points, links):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


@pytest.mark.parametrize("shape", ["spread", "ball"])
def test_large_leaves_are_split_again(spark, shape):
    rng = np.random.default_rng(11)
    one = lambda n: np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    if shape == "spread":
        far = rng.integers(0, 2**64, 1500, dtype=np.uint64)
        points = np.unique(np.concatenate([far, far[:700] ^ one(700), far[:300] ^ one(300) ^ one(300)]))
    else:  # no vantage point parts points that are all six bits apart or closer
        points = np.unique(np.uint64(12345) ^ one(1500) ^ one(1500) ^ one(1500))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    shards = simhash.shards_of(df, 2, shard_points=16, tree_sample=32, leaf_points=200).groupBy("shard").count().collect()
    assert max(r["count"] for r in shards) <= (200 if shape == "spread" else 260) and len(shards) > len(points) / 200
    links = simhash.link_fingerprints(df, 2, shard_points=16, tree_sample=32, leaf_points=200).collect()
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    signed = [int(p) for p in points.view(np.int64)]
    pairs = [(signed[i], signed[j]) for i, j in zip(*np.nonzero(near)) if i > j]
    assert _linked(signed, [(r.a, r.b) for r in links]) == _linked(signed, pairs)


def test_star_joins_store_few_files_however_many_shuffle_partitions(spark):
    links = spark.createDataFrame([Row(a=i + 1, b=i) for i in range(20)])
    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", "61")
    wide.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    wide.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = simhash.connected(wide.createDataFrame(links.collect()), links.count())
    assert {r.node: r.root for r in found.collect()} == {i: 0 for i in range(1, 21)}
    assert found.rdd.getNumPartitions() <= wide.sparkContext.defaultParallelism
