"""Periodic runs against a direct search for every period."""

import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
from pyspark.sql import types as T

from wavefold.llm import periodic_runs, queries


def brute(x):
    n, out = len(x), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            end = j + q
            smaller = any(all(x[k] == x[k + t] for k in range(i, end - t)) for t in range(1, q) if q % t == 0)
            if end - i >= max(24, 3 * q) and not smaller:
                out.append((i, end - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(rng, size):
    x = []
    while len(x) < size:
        if rng.random() < 0.3:
            x += [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randrange(30))]
        else:
            root = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(1, rng.choice([4, 12, 40, 70])))]
            x += (root * 200)[:rng.randrange(1, 200)]
    return x


def found_in(x):
    got = periodic_runs.runs_of(np.array(x, np.int64), np.array([0]), np.array([len(x)])).get(0, [])
    return sorted(got, key=lambda r: (r[0], r[2]))


def test_runs_equal_direct_search():
    rng = random.Random(3)
    for _ in range(120):
        docs = [made(rng, rng.randrange(350)) for _ in range(rng.randrange(1, 4))]
        ends = np.cumsum([len(d) for d in docs])
        got = periodic_runs.runs_of(np.array(sum(docs, []), np.int64), ends - [len(d) for d in docs], ends)
        for k, d in enumerate(docs):
            assert sorted(got.get(k, []), key=lambda r: (r[0], r[2])) == brute(d)


def test_heads_shorter_than_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "LONGEST_HEAD", 8)
    rng = random.Random(4)
    for _ in range(30):
        root = [rng.randrange(4) for _ in range(rng.randrange(1, 150))]
        x = [rng.randrange(4) for _ in range(rng.randrange(40))] + (root * 5)[:rng.randrange(60, 700)]
        assert found_in(x) == brute(x)


def test_equal_hashes_are_seen_through(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_HASHES", ((3, 2),))
    rng = random.Random(8)
    for _ in range(40):
        x = made(rng, 250)
        assert set(found_in(x)) <= set(brute(x))


def test_transform_finds_every_occurrence():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (5, 48))
    got = periodic_runs.occurrences(x[:, :16], x)
    want = [[np.array_equal(row[:16], row[d:d + 16]) for d in range(32)] for row in x]
    assert got.tolist() == want


def test_long_texts_of_few_words_stay_linear():
    n = 200_000
    assert found_in([0] * n) == [(0, n, 1)]
    assert found_in([0, 1] * (n // 2)) == [(0, n, 2)]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{v}" for v in made(rng, rng.randrange(200)))) for i in range(150)]
    rows += [(None, "a " * 30), (500, None), (501, ""), (502, " \t\n "), (7, rows[7][1]), (7, "x y " * 20)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("start", T.StringType())])
    spark.createDataFrame([(*r, "clash") for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.runs(docs).collect() == []
