"""Reshape, participation and pivots."""

import pytest
from pyspark.sql import functions as F

from wavefold.operators import participation as pa
from wavefold.operators import reshape as rs


def test_wide_to_long_drops_empty_wave(spark):
    df = spark.createDataFrame([(1, None, None, 5.0, "x"), (2, 1.0, None, None, None)],
                               "uid int, a_03 double, b_03 string, a_12 double, b_12 string")
    got = sorted((r["uid"], r["year"], r["a"], r["b"]) for r in rs.wide_to_long(df).collect())
    assert got == [(1, 2012, 5.0, "x"), (2, 2003, 1.0, None)]


def test_pivot_change_zero_and_duplicates(spark):
    df = spark.createDataFrame([(1, 2016, 3.0), (1, 2021, 0.0), (2, 2016, 4.0), (2, 2021, 2.0), (3, 2016, 1.0)],
                               "uid int, year int, composite_score double")
    got = {r["uid"]: r["composite_score_diff"] for r in rs.pivot_change(df).collect()}
    assert got == {1: None, 2: 1.0, 3: None}
    dup = df.unionByName(spark.createDataFrame([(2, 2016, 9.0)], df.schema))
    with pytest.raises(Exception):
        rs.pivot_change(dup).collect()


def test_onehot_fixed_schema(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    oh = rs.fit_onehot(train, ["c"])
    test = spark.createDataFrame([("b",), ("zz",), (None,)], "c string")
    out = oh.apply(test)
    assert out.columns == ["c__a", "c__b", "c__nan"]
    assert [tuple(r) for r in out.collect()] == [(0, 1, 0), (0, 0, 0), (0, 0, 1)]


def test_melt_predictions(spark):
    df = spark.createDataFrame([(1, 2016, 1.0, 2.0, 3.0)],
                               "uid int, year int, composite_score_lgb_seed_0 double, "
                               "composite_score_lgb_seed_1 double, composite_score_linear1 double")
    got = sorted((r["model"], r["seed"], r["predicted_score"]) for r in
                 rs.melt_predictions(df, ["uid", "year"]).collect())
    assert got == [("lgb", 0, 1.0), ("lgb", 1, 2.0), ("linear1", None, 3.0)]


def test_participation_vocab_unseen_is_null(spark):
    long_tr = spark.createDataFrame([(1, 2003), (1, 2012), (2, 2012)], "uid int, year int")
    lab_tr = spark.createDataFrame([(1, 2016), (2, 2016), (2, 2021)], "uid int, year int")
    pats = pa.year_patterns(long_tr, lab_tr)
    got = {r["uid"]: r["pattern"] for r in pats.collect()}
    assert got == {1: "[2003, 2012, 2016]", 2: "[2012, 2016, 2021]"}
    vocab = pa.fit_pattern_vocab(pats)
    long_te = spark.createDataFrame([(9, 2003)], "uid int, year int")
    keys_te = spark.createDataFrame([(9, 2016)], "uid int, year int")
    te = vocab.apply(pa.year_patterns(long_te, keys_te)).first()
    assert te["year_participation"] is None


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = pa.dense_index(df, ["k"], "i").collect()
    assert sorted(r["i"] for r in out) == list(range(1000))
    assert all(r["i"] == r["k"] for r in out)
