"""The size-aware similarity join against a comparison of all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from wavefold.llm.bitmaps import hash_bits, hit
from wavefold.llm import jaccard_join, queries
from wavefold.llm.words import word_hashes

SCHEMA = "doc_id long, text string, key string, n long"


def brute(rows, k, percent):
    sets = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
        sets.append(grams)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(row[0], least.get(find(i), row[0]))
    return sorted(((row[0], len(sets[i]), least.get(find(i)) if sets[i] else row[0]) for i, row in enumerate(rows)), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            words.insert(at, f"n{rng.randrange(400)}")
        elif at < len(words) and len(words) > 1:
            words[at:at + 1] = [f"n{rng.randrange(400)}"] if kind == 1 else []
    return words


def made(seed, groups, long):
    rng = random.Random(seed)
    rows = []
    passage = [f"p{i}" for i in range(30)]
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, long))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            words = edited(rng, base, rng.choice([0, 0, 1, 2, 4, 8]))
            rows.append((rng.randrange(2000), " ".join(words).replace("w1", "W1"), "clash", 5))
    rows += rows[:5]
    rows += [(1, None, None, None), (2, "", None, None), (2, " \t\n", None, None), (None, "lonely words of nobody here at all", None, None),
             (None, "x y", None, None), (None, "x y", None, None), (3, "x  Y", None, None)]
    return rows


@pytest.mark.parametrize("seed,groups,long,k,percent", [(1, 60, 14, 1, 80), (2, 50, 90, 5, 80), (3, 50, 40, 2, 60), (4, 60, 30, 5, 80)])
def test_components_equal_all_pairs(spark, seed, groups, long, k, percent):
    rows = made(seed, groups, long)
    got = jaccard_join.components(spark.createDataFrame(rows, SCHEMA).repartition(3), k=k, percent=percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, percent)


def test_lists_that_join_many_components_are_worked_off_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PIVOTS_GROW", 2)
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for g in range(25):  # texts that are mostly one passage: near enough to be listed together, most of them not near
        own = passage + [f"g{g}x{i}" for i in range(rng.randrange(6, 12))]
        rows += [(len(rows) + i, " ".join(edited(rng, own, i)), None, None) for i in range(3)]
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: 0)
    got = jaccard_join.components(spark.createDataFrame(rows, SCHEMA), k=1, percent=80)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 1, 80)


def test_a_hot_group_of_near_copies_is_not_paired_out(spark, monkeypatch):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 1)), None, None) for i in range(300)]
    rows += [(1000 + i, " ".join(f"z{i}y{j}" for j in range(20)), None, None) for i in range(50)]
    seen = []
    plain = jaccard_join.compared
    monkeypatch.setattr(jaccard_join, "compared", lambda pairs, *a: seen.append(pairs.count()) or plain(pairs, *a))
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", 1000)
    got = jaccard_join.components(spark.createDataFrame(rows, SCHEMA), k=5, percent=80)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 5, 80)
    assert sum(seen) < 15 * len(rows)


def test_sizes_of_overlaps():
    for a in range(1, 40):
        for b in range(1, 40):
            want = next(o for o in range(a + b + 1) if 100 * o >= 80 * (a + b - o))
            assert jaccard_join.needed(a, b, 80) == want
    assert jaccard_join.boundary({}, 80) == 0
    assert 4 <= jaccard_join.boundary({n: 1000 for n in range(1, 33)}, 80) < 32


def test_short_texts_are_one_shingle():
    sets = jaccard_join.shingle_sets(["a b", "a b c d e", "a b c d e f", "", "A  B"], 5)
    assert [len(s) for s in sets] == [1, 1, 2, 0, 1]
    assert sets[0] == sets[4] and sets[1][0] in sets[2] and not np.isin(sets[0], sets[2]).any()


def test_empty_table(spark):
    assert jaccard_join.components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_is_registered(spark):
    assert "op11_jaccard_join" in queries.QUERIES


def test_parities_differ_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(3)
    for n, apart in ((0, 5), (40, 0), (40, 7), (300, 60), (5000, 900)):
        both, a, b = (np.unique(rng.integers(0, 1 << 63, m, dtype=np.uint64)) for m in (n, apart, apart))
        x, y = (jaccard_join.parities(np.concatenate((both, one))) for one in (a, b))
        differ = sum(int(v).bit_count() for v in np.bitwise_xor(x, y).view(np.uint64))
        assert len(x) == 8 and differ <= len(a) + len(b) and (apart or differ == 0)


def test_pairs_that_differ_too_much_are_not_compared(spark, monkeypatch):
    # 40 texts share a passage that makes up too little of each: every list of it used to be compared pair by pair
    rng, seen = random.Random(4), []
    passage = " ".join(f"p{i}" for i in range(20))
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(25)) for _ in range(40)]
    rows = [(i, f"{passage} {text}", "x", 1) for i, text in enumerate([*own, own[0] + " end"])]
    plain = jaccard_join.compared
    monkeypatch.setattr(jaccard_join, "compared", lambda pairs, *a: seen.append(pairs.count()) or plain(pairs, *a))
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: 0)
    got = jaccard_join.components(spark.createDataFrame(rows, SCHEMA), k=5, percent=80)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 5, 80)
    assert sum(seen) < 40


def test_a_bitmap_comes_in_one_job_however_many_shuffle_partitions(spark):
    wide = spark.newSession()
    wide.conf.set("spark.sql.shuffle.partitions", "61")
    wide.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    group = "bitmap-jobs"
    wide.sparkContext.setJobGroup(group, group)
    bits = hash_bits(wide.range(500).selectExpr("xxhash64(id) AS h")).value
    jobs = wide.sparkContext.statusTracker().getJobIdsForGroup(group)
    wide.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    hashes = np.array([r.h for r in spark.range(500).selectExpr("xxhash64(id) AS h").collect()], np.int64).view(np.uint64)
    assert hit(bits, hashes).all()
    assert len(jobs) < 10


def test_later_rounds_make_only_pairs_that_may_link(spark, monkeypatch):
    # texts that share a passage nobody else has are in its lists, but too far apart: all members times all pivots were made
    rng, made_pairs, fetched = random.Random(9), [], []
    passage, pool = " ".join(f"p{i}" for i in range(10)), [f"w{i}" for i in range(150)]
    rows = [(i, (f"{passage} " if i < 60 else "") + " ".join(rng.sample(pool, 60)), None, None) for i in range(160)]
    rows += [(200 + i, rows[i][1] + " end", None, None) for i in range(5)]
    plain = jaccard_join._pairs
    monkeypatch.setattr(jaccard_join, "_pairs", lambda *a: (lambda p: made_pairs.append(p.count()) or p)(plain(*a)))
    texts_of = jaccard_join._texts_of
    monkeypatch.setattr(jaccard_join, "_texts_of", lambda rows, wanted, k: fetched.append(wanted.count()) or texts_of(rows, wanted, k))
    monkeypatch.setattr(jaccard_join, "boundary", lambda sizes, percent: 0)
    got = jaccard_join.components(spark.createDataFrame(rows, SCHEMA), k=1, percent=80)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 1, 80)
    assert len(made_pairs) > 1 and sum(made_pairs[1:]) < 100
    assert sum(fetched) < 40  # texts of what is compared, not of all the lists


def test_word_hashes_are_those_of_the_words():
    rng = random.Random(11)
    texts = ["", " \t\n\x0b\x0c\r", "a", "x" * 64, "x" * 65 + " y", "x" * 200, "a\x00 a a\x00\x00", "\x1c b", "éa é", "aaaaaaaa aaaaaaaaa " * 3]
    texts = [t.encode() for t in texts + ["".join(rng.choice(" ab\t\x00é") for _ in range(rng.randrange(60))) for _ in range(300)] + [""]]
    h, n_words = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert n_words.tolist() == [len(t.split()) for t in texts] and len(h) == len(words)
    said = dict(zip(words, h.tolist()))
    assert [said[w] for w in words] == h.tolist() and len(set(said.values())) == len(said)
    assert [len(x) for x in word_hashes([])] == [0, 0]
