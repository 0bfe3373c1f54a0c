"""Distributed prefix sums and average precision against brute force."""

import numpy as np

from wavefold.operators.quantiles import prefix_sums
from wavefold.operators.report import average_precision


def brute_ap(y, s):
    """Average precision over distinct thresholds (step-wise, no interpolation)."""
    order = sorted(set(s), reverse=True)
    P = sum(y)
    ap, tp, n = 0.0, 0, 0
    for t in order:
        pos = sum(1 for yi, si in zip(y, s) if si == t and yi)
        cnt = sum(1 for si in s if si == t)
        tp += pos
        n += cnt
        ap += pos / P * tp / n
    return ap


def test_prefix_sums_match_cumsum(spark):
    rng = np.random.default_rng(5)
    rows = [(k, int(o), float(v)) for k in ("a", "b", "c") for o, v in
            zip(rng.permutation(700), rng.normal(size=700))]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    got = {(r["k"], r["o"]): r["v_cum"] for r in prefix_sums(df, "o", ["v"], keys=["k"]).collect()}
    for k in ("a", "b", "c"):
        sub = sorted((o, v) for kk, o, v in rows if kk == k)
        cum = np.cumsum([v for _, v in sub])
        for (o, _), c in zip(sub, cum):
            assert abs(got[(k, o)] - c) < 1e-9


def test_prefix_sums_null_keys_are_a_group(spark):
    rows = [(None if i % 3 == 0 else "ab"[i % 2], None if i % 5 == 0 else i % 4, i, float(i % 7)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, n int, o int, v double").repartition(6)
    got = {r["o"]: r["v_cum"] for r in prefix_sums(df, "o", ["v"], keys=["k", "n"]).collect()}
    for k in {(r[0], r[1]) for r in rows}:
        total = 0.0
        for _, _, o, v in (r for r in rows if (r[0], r[1]) == k):
            total += v
            assert abs(got[o] - total) < 1e-9


def test_prefix_sums_descending_no_keys(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(500)], "o int, v double")
    got = {r["o"]: r["v_cum"] for r in prefix_sums(df, "o", ["v"], descending=True).collect()}
    assert all(got[i] == 500 - i for i in range(500))


def test_average_precision_brute_force(spark):
    rng = np.random.default_rng(11)
    s = rng.integers(0, 30, size=400).astype(float)           # many ties
    y = (rng.random(400) < 1 / (1 + np.exp(-(s - 15) / 4))).astype(int)
    m = np.where(np.arange(400) % 2 == 0, "x", "y")
    df = spark.createDataFrame([(str(mm), int(yy), float(ss)) for mm, yy, ss in zip(m, y, s)],
                               "m string, y int, s double")
    got = {r["m"]: r["average_precision"] for r in average_precision(df, "y", "s", ["m"]).collect()}
    for key in ("x", "y"):
        idx = m == key
        assert abs(got[key] - brute_ap(list(y[idx]), list(s[idx]))) < 1e-12
