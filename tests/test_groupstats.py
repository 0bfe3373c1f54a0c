"""Group statistics against brute-force pandas/numpy references."""

import math

import numpy as np
import pandas as pd
import pytest

from wavefold.operators import groupstats as gs


def brute_peaks(x):
    """Interior strict maxima with plateaus counted once (find_peaks semantics)."""
    runs = [v for i, v in enumerate(x) if i == 0 or v != x[i - 1]]
    return sum(1 for i in range(1, len(runs) - 1) if runs[i] > runs[i - 1] and runs[i] > runs[i + 1])


def brute_stats(v):
    s = pd.Series(v, dtype=float)
    n = len(s)
    tot = s.sum()
    gini = 0.0 if tot == 0 else sum(abs(a - b) for a in s for b in s) / (2 * n * tot)
    p = s.value_counts(normalize=True)
    ent = float(-(p * np.log(p)).sum())
    allpos = bool((s > 0).all())
    return {
        "min": s.min(), "max": s.max(), "mean": s.mean(), "std": s.std(), "skew": s.skew(),
        "median": s.median(), "range": s.max() - s.min(), "iqr": s.quantile(0.75) - s.quantile(0.25),
        "mad": (s - s.mean()).abs().mean(), "cv": 0.0 if s.mean() == 0 else s.std() / s.mean(),
        "gini": gini, "entropy": ent,
        "harmonic_mean": n / (1 / s).sum() if allpos else 0.0,
        "geometric_mean": float(np.exp(np.log(s).mean())) if allpos else 0.0,
        "q1_20": s.quantile(0.2), "q2_40": s.quantile(0.4), "q3_60": s.quantile(0.6), "q4_80": s.quantile(0.8),
    }


def close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return False
    return abs(a - b) <= 1e-9 * max(1.0, abs(b))


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    rows = []
    sizes = {"one": 1, "two": 2, "three": 3, "const": 6, "neg": 5, "big": 400, "mid": 57}
    for g, n in sizes.items():
        for i in range(n):
            if g == "const":
                x = 4.0
            elif g == "neg":
                x = [-1.0, 0.0, 2.0, 1.0, -3.0][i]
            else:
                x = float(rng.integers(0, 12))
            rows.append((g, i, x))
    return rows


def test_order_free_stats_match_pandas(spark, frame):
    df = spark.createDataFrame(frame, "g string, o int, x double")
    got = {r["g"]: r.asDict() for r in gs.order_free_stats(df, ["g"], "x").collect()}
    pdf = pd.DataFrame(frame, columns=["g", "o", "x"])
    for g, sub in pdf.groupby("g"):
        exp = brute_stats(sub["x"].tolist())
        for k, v in exp.items():
            assert close(got[g][k], None if pd.isna(v) else float(v)), (g, k, got[g][k], v)


def test_small_group_rules(spark, frame):
    df = spark.createDataFrame(frame, "g string, o int, x double")
    got = {r["g"]: r for r in gs.order_free_stats(df, ["g"], "x").collect()}
    assert got["one"]["std"] is None and got["one"]["skew"] is None
    assert got["two"]["skew"] is None and got["two"]["std"] is not None
    assert got["const"]["skew"] == 0.0 and got["const"]["cv"] == 0.0 and got["const"]["iqr"] == 0.0
    # negative values and zero: harmonic / geometric means are 0
    assert got["neg"]["harmonic_mean"] == 0.0 and got["neg"]["geometric_mean"] == 0.0


def test_gini_zero_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), ("a", 0.0)], "g string, x double")
    assert gs.order_free_stats(df, ["g"], "x").first()["gini"] == 0.0


def test_null_key_and_null_values(spark):
    rows = [(None, 1.0), (None, 2.0), ("a", 1.0), ("a", None), ("a", 3.0), ("b", 2.0), ("b", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r for r in gs.order_free_stats(df, ["g"], "x").collect()}
    assert set(got) == {"a", "b"}                      # null key dropped
    assert got["a"]["mean"] == 2.0 and got["a"]["min"] == 1.0
    assert got["a"]["harmonic_mean"] == 0.0           # a null fails "all values > 0"
    assert close(got["b"]["harmonic_mean"], 2 / (1 / 2 + 1 / 4))


@pytest.mark.parametrize("seq,peaks,troughs", [
    ([1, 3, 3, 2, 5, 5], 1, 1),
    ([5, 5, 1, 1, 5], 0, 1),
    ([2, 2, 2], 0, 0),
    ([1, 2, 1, 2, 1, 2, 1], 3, 2),
    ([3], 0, 0),
])
def test_peaks_plateaus(spark, seq, peaks, troughs):
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(seq)], "g string, o int, x double")
    r = gs.peaks_troughs(df, ["g"], "x", ["o"]).first()
    assert (r["peaks"], r["troughs"]) == (peaks, troughs)


def test_peaks_across_partitions_match_bruteforce(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        n = [1, 2, 50, 300, 1000, 7][g]
        vals = rng.integers(0, 4, size=n)     # many plateaus
        rows += [(f"g{g}", i, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, o int, x double").repartition(5)
    got = {r["g"]: (r["peaks"], r["troughs"]) for r in gs.peaks_troughs(df, ["g"], "x", ["o"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "o", "x"]).sort_values(["g", "o"])
    for g, sub in pdf.groupby("g"):
        x = sub["x"].tolist()
        assert got[g] == (brute_peaks(x), brute_peaks([-v for v in x])), g


def test_multi_key_equals_single_key(spark, frame):
    rows = [(g, o % 3, o, x) for g, o, x in frame]
    df = spark.createDataFrame(rows, "g string, h int, o int, x double")
    multi = {(r["group_var"], r["group_value"]): r for r in
             gs.group_stats_multi(df, ["g", "h", "missing_col"], "x", ["o"]).collect()}
    single = {r["h"]: r for r in gs.group_stats(df, ["h"], "x", ["o"]).collect()}
    for h, r in single.items():
        m = multi[("h", str(h))]
        for k in gs.STAT_NAMES:
            assert close(m[k], r[k]), (h, k)


def test_join_group_stats_prefixes(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, None, 5.0)], "uid int, g string, x double")
    st = gs.group_stats_multi(df, ["g"], "x")
    out = {r["uid"]: r for r in gs.join_group_stats(df, st, ["g"], ["mean"]).collect()}
    assert out[1]["g__mean"] == 2.0 and out[3]["g__mean"] is None


def test_peaks_of_many_columns(spark):
    rng = np.random.default_rng(21)
    n = 3000
    rows = [(int(i), int(rng.integers(0, 4)), str(rng.integers(0, 3)) if i % 11 else None,
             float(rng.integers(0, 5))) for i in range(n)]
    df = spark.createDataFrame(rows, "o int, a int, b string, x double").repartition(7)
    many = {(r["group_var"], r["group_value"]): (r["peaks"], r["troughs"])
            for r in gs.group_stats_multi(df, ["a", "b"], "x", ["o"]).collect()}
    pdf = pd.DataFrame(rows, columns=["o", "a", "b", "x"]).sort_values("o")
    for g in ("a", "b"):
        for v, sub in pdf[pdf[g].notna()].groupby(g):
            xs = sub["x"].tolist()
            assert many[(g, str(v))] == (brute_peaks(xs), brute_peaks([-t for t in xs])), (g, v)


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: results equal pandas, whatever the partitioning."""
    rng = np.random.default_rng(4)
    rows = [("hot" if i % 3 == 0 else f"k{i % 97}", i, float(rng.integers(0, 20))) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, o int, x double").repartition(11)
    got = {r["g"]: r for r in gs.group_stats(df, ["g"], "x", ["o"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "o", "x"]).sort_values("o")
    sub = pdf[pdf["g"] == "hot"]
    exp = brute_stats(sub["x"].tolist())
    for k in ("mean", "std", "skew", "median", "iqr", "q4_80", "entropy"):
        assert close(got["hot"][k], float(exp[k])), k
    xs = sub["x"].tolist()
    assert (got["hot"]["peaks"], got["hot"]["troughs"]) == (brute_peaks(xs), brute_peaks([-v for v in xs]))
