"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from wavefold.llm import bitmaps, collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, a long"


def brute(rows, support, top, inside):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(ws)
            f.update((lang, *ws[i:i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= support}
    out = []
    for p, a in cands.items():
        lang, ws = p[0], p[1:]
        around = [b for q, b in cands.items() if q[0] == lang and len(q) > len(p)
                  and any(q[i:i + len(ws)] == ws for i in range(1, len(q) - len(ws) + 1))]
        if any(100 * b >= inside * a for b in around):
            continue
        cuts = [(2000000 * a // (f[(lang, *ws[:k])] + f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, " ".join(ws), a, f[(lang, *ws[:k])], f[(lang, *ws[k:])], n[lang], score))
    want = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        want += [(o[0], rank, *o[1:]) for rank, o in enumerate(own, 1)]
    return sorted(want)


def made(seed, docs=250):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "É", "été", "x.y", "no!", "b\tc", "d\ne", "f\x0bg", "\x1c", "日本", "the,", "\x00"] + [f"w{i}" for i in range(25)]
    rows = []
    for i in range(docs):
        text = "  ".join(rng.choice(words[:rng.choice([4, 8, 40])]) for _ in range(rng.randrange(60)))
        if rng.random() < 0.3:
            text += " red hot chili peppers " * rng.randrange(4)
        rows.append((rng.choice([i, 7, None]), text, rng.choice(["en", "en", "und", None, "de"]), "clash", 1))
    rows += rows[:20]
    rows += [(900, None, "en", None, None), (901, "", None, None, None), (902, "the " * 500, "en", None, None),
             (903, "only one", "xx", None, None)]
    return rows


@pytest.mark.parametrize("support,shards,chunk,seed", [(30, 8, 2_000_000, 1), (5, 3, 300, 2), (12, 1, 50, 3)])
def test_counts_and_ranks_equal_brute_force(spark, monkeypatch, support, shards, chunk, seed):
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    rows = made(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    top = 40 if seed == 2 else 2000
    got = collocations.collocations(docs, support=support, top=top, shards=shards)
    assert sorted(map(tuple, got.collect())) == brute(rows, support, top, 80)


def test_full_bitmaps_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "LEAST_BITS", 8)
    monkeypatch.setattr(bitmaps, "MOST_BITS", 8)  # every bit is set
    rows = made(9, 120)
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA), support=6, shards=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 6, 2000, 80)


def test_hash_bits_hold_exactly_the_hashes(spark):
    values = [0, 1, 32767, 32768, -1, 5_000_000_000, -(2 ** 63), 2 ** 63 - 1, 262_143, 262_142]
    bits = bitmaps.hash_bits(spark.createDataFrame([(v,) for v in values], "g long")).value
    n = len(bits) * 8
    assert sorted(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == sorted({v % n for v in values})


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
