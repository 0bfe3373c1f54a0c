"""Binning, top-k, recodes and cleaning against pandas."""

import numpy as np
import pandas as pd
import pytest

from wavefold.operators import clean as cl
from wavefold.operators import features as fe
from wavefold.operators.quantiles import exact_quantiles, exact_quantiles_many


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=500), np.zeros(400)])   # a hot value
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs)
    exp = np.quantile(vals, probs)          # linear, pandas' default
    assert np.allclose(got, exp, rtol=0, atol=1e-12)


def test_qcut_ties_match_pandas(spark):
    vals = [1, 2, 2, 2, 3, 4, 5, 6, 7, 8]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    got = [r["c"] for r in fe.qcut(df, "x", 4, out="c").orderBy("i").collect()]
    assert got == list(pd.qcut(pd.Series(vals, dtype=float), 4, labels=False))


def test_qcut_duplicate_edges(spark):
    vals = [1, 2, 2, 2, 2, 2, 3]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    with pytest.raises(ValueError):
        fe.qcut(df, "x", 4)
    got = sorted(r["c"] for r in fe.qcut(df, "x", 4, out="c", duplicates="drop").collect())
    exp = sorted(pd.qcut(pd.Series(vals, dtype=float), 4, labels=False, duplicates="drop"))
    assert got == exp


def test_train_edges_right_closed_out_of_range(spark):
    train = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8]], "x double")
    bins = fe.fit_bins(train, ["x"], 4)
    test = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 2.0, 2.5, 8.0, 9.0, None]], "x double")
    got = [r["x_q"] for r in bins.apply(test).collect()]
    edges = bins.edges["x"]
    exp = pd.cut(pd.Series([-1.0, 0.0, 2.0, 2.5, 8.0, 9.0, None]), bins=edges, labels=False, include_lowest=True)
    assert got == [None if pd.isna(v) else int(v) for v in exp]


def test_top_k_other_for_unseen(spark):
    train = spark.createDataFrame([(v,) for v in "aaabbbccdde"], "c string")
    tk = fe.fit_top_k(train, "c", 3)
    assert tk.values == ["a", "b", "c"]
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [r["c"] for r in tk.apply(test).collect()] == ["a", "other", "other"]


def test_ordinal_and_bands(spark):
    df = spark.createDataFrame([("lo",), ("hi",), ("odd",), (None,)], "x string")
    enc = cl.ordinal_encode(df, {"x": ["lo", "mid", "hi"], "missing": ["a"]})
    assert [r["x"] for r in enc.collect()] == [1, 3, None, None]
    bands = spark.createDataFrame([("0. none",), ("7",), ("x",)], "b string")
    assert [r["b"] for r in cl.recode_bands(bands, {"b": {"0. none": 0}}).collect()] == [0.0, 7.0, None]


def test_narrow_age_rules(spark):
    ranges = {"A": (40, 49), "B": (50, 59)}
    df = spark.createDataFrame([("A", "A"), ("A", "B"), ("A", None), ("A", "Z")], "a string, b string")
    got = [(r["narrowed_age_03"], r["narrowed_age_12"]) for r in cl.narrow_age(df, "a", "b", ranges).collect()]
    assert got == [(40.0, 49.0), (49.5, 58.5), (None, None), (None, None)]


def test_winsorize_keeps_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in range(100)] + [(None,)], "x double")
    out = [r["x"] for r in cl.winsorize(df, ["x"], 0.99).collect()]
    q = float(np.quantile(np.arange(100.0), 0.99))
    assert max(v for v in out if v is not None) == q and out[-1] is None


def test_sparse_rows_threshold(spark):
    rows = [(1, None, None, 1, 1), (2, 1, None, 1, None), (3, 1, 1, None, None)]
    df = spark.createDataFrame(rows, "uid int, a_03 int, b_03 int, a_12 int, b_12 int")
    # width 2 → keep if nulls < int(3/2) = 1
    kept = [r["uid"] for r in cl.drop_sparse_rows(df, ["a_03", "b_03"], ["a_12", "b_12"], None, None).collect()]
    assert kept == []
    # uid 1: both first-wave values missing equals the "all missing" count → kept
    kept = [r["uid"] for r in cl.drop_sparse_rows(df, ["a_03", "b_03"], ["a_12", "b_12"], 2, None).collect()]
    assert kept == [1]
    rows2 = [(4, 1, 1, 1, 1)]
    df2 = spark.createDataFrame(rows2, "uid int, a_03 int, b_03 int, a_12 int, b_12 int")
    assert cl.drop_sparse_rows(df2, ["a_03", "b_03"], ["a_12", "b_12"]).count() == 1


def test_first_per_key_and_align(spark):
    df = spark.createDataFrame([(1, 2021, 5.0), (1, 2016, 3.0), (2, 2021, 1.0)], "uid int, year int, s double")
    got = {r["uid"]: (r["year"], r["s"]) for r in cl.first_per_key(df, "uid", ["year"]).collect()}
    assert got == {1: (2016, 3.0), 2: (2021, 1.0)}
    al = cl.align_schema(df, ["s", "new", "uid"], fill=0)
    assert al.columns == ["s", "new", "uid"] and al.first()["new"] == 0


def test_positive_log_and_differences(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0, 1, 3)], "uid int, hincome_03 double, hincome_12 double, n_03 int, n_12 int")
    out = fe.wave_differences(fe.log_columns(df)).first()
    assert out["hincome_12"] is None and abs(out["hincome_03"] - np.log(2.0)) < 1e-12
    assert out["n_diff"] == -2


def test_sample_columns_deterministic(spark):
    df = spark.createDataFrame([tuple(range(10))], ",".join(f"c{i} int" for i in range(10)))
    a = cl.sample_columns(df, 0.5, keep=["c0"], seed=42).columns
    b = cl.sample_columns(df, 0.5, keep=["c0"], seed=42).columns
    assert a == b and "c0" in a and len(a) == 10 - int(9 * 0.5)


def test_value_counts_long_nan_label(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", None)], "s string, n int")
    got = {(r["Feature"], r["Categories"]): r["N"] for r in fe.value_counts_long(df, ["s", "n"]).collect()}
    assert got == {("s", "a"): 2, ("s", "nan"): 1, ("n", "1"): 2, ("n", "nan"): 1}


def test_exact_quantiles_bring_only_the_answer_to_the_driver(spark, monkeypatch):
    from pyspark.sql import DataFrame

    rng = np.random.default_rng(2)
    data = {f"c{i}": rng.normal(size=5000) for i in range(6)}
    rows = [tuple(float(v) for v in r) for r in zip(*data.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).coalesce(1)
    brought = []
    for name in ("collect", "toPandas", "first", "head", "take"):
        def counting(self, *a, f=getattr(DataFrame, name), **k):
            out = f(self, *a, **k)
            brought.append(len(out) if hasattr(out, "__len__") and name != "first" else 1)
            return out
        monkeypatch.setattr(DataFrame, name, counting)
    probs = [0.1, 0.5, 0.9]
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # every column in one partition
    try:
        got = exact_quantiles_many(df, list(data), probs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    assert sum(brought) <= 2 * len(probs) * len(data)
    for c, v in data.items():
        assert np.allclose(got[c], np.quantile(v, probs), rtol=0, atol=1e-12)


def test_exact_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_quantiles_many(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.5]}
    assert exact_quantiles_many(df.limit(0), ["a", "b"], [0.5]) == {"a": [None], "b": [None]}


def test_exact_quantiles_many_columns(spark):
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=800), rng.integers(0, 5, size=800).astype(float)
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.0, 0.3, 0.5, 0.99, 1.0]
    got = exact_quantiles_many(df, ["a", "b"], probs)
    bb = np.array([r[1] for r in rows if r[1] is not None])
    assert np.allclose(got["a"], np.quantile(a, probs), atol=1e-12)
    assert np.allclose(got["b"], np.quantile(bb, probs), atol=1e-12)
