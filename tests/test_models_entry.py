"""Model invariants, IO round trips and the driver contract at sf0.001."""

import math
import os
import tempfile

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from wavefold.operators import models as mo
from wavefold.plans import q_models
from wavefold.plans.fixtures import TABLES
from wavefold.sources import io

SF = "/root/testdata/sf0.001"


def test_oof_each_row_once_and_fold_kept(spark):
    x, _ = q_models.model_table(spark, SF)
    est = mo.make_regressor("forest", {"numTrees": 5}, 42)
    oof = mo.oof_predict(x, est, "fold", ["uid", "year"])
    assert oof.count() == x.count()
    assert oof.select("uid", "year").distinct().count() == x.count()
    joined = oof.join(x.select("uid", "year", F.col("fold").alias("f0")), ["uid", "year"])
    assert joined.where(F.col("fold") != F.col("f0")).count() == 0


def test_same_seed_same_predictions(spark):
    x, _ = q_models.model_table(spark, SF)
    est = mo.make_regressor("gbt_shallow", {"maxIter": 5}, 7)
    a = {(r["uid"], r["year"]): r["prediction"] for r in est.fit(x).transform(x).collect()}
    b = {(r["uid"], r["year"]): r["prediction"] for r in est.fit(x).transform(x).collect()}
    assert a == b


def test_class_probabilities_sum_to_one(spark):
    x, _ = q_models.model_table(spark, SF)
    p = mo.class_probabilities(x, "composite_score", 4, "fold", ["uid", "year"], 42)
    cols = [f"quantile_{i}_4" for i in range(4)]
    for r in p.collect():
        assert math.isclose(sum(r[c] for c in cols), 1.0, abs_tol=1e-9)


def test_survey_csv_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="wavefold-test-", dir="/tmp")
    path = os.path.join(d, "f.csv")
    with open(path, "w") as fh:
        fh.write("uid,age,score\n1,NA,1.5\n2,n/a,\n3,40,NaN\n4,null,2\n")
    df = io.read_survey_csv(spark, path, "uid string, age int, score double")
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", None, 1.5), ("2", None, None), ("3", 40, None), ("4", None, 2.0)]


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and len(orc) >= 60


def test_some_oracles_match_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    for name in ("group_stats_multi_key", "participation_code", "softmax_blend", "poisson_bootstrap_se"):
        s = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in
                   qs[name](spark, SF).select(*sorted(qs[name](spark, SF).columns)).collect())
        rel = con.sql(orc[name])
        cols = sorted(rel.columns)
        d = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in
                   con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({orc[name]})").fetchall())
        assert s == d, name


def test_survey_csv_inferred_types(spark):
    d = tempfile.mkdtemp(prefix="wavefold-test-", dir="/tmp")
    path = os.path.join(d, "g.csv")
    with open(path, "w") as fh:
        fh.write("uid,n,x,s\na1,1,1.5,u\na2,NA,2,v\na3,3,nan,\n")
    df = io.read_survey_csv(spark, path)
    assert dict(df.dtypes) == {"uid": "string", "n": "bigint", "x": "double", "s": "string"}
    assert sorted(tuple(r) for r in df.collect()) == [("a1", 1, 1.5, "u"), ("a2", None, 2.0, "v"), ("a3", 3, None, None)]


def test_names_roundtrip_and_schema_difference(spark):
    from wavefold.operators import clean as cl
    from wavefold.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark)}/names-test"
    io.save_names(spark, ["b", "a", "c"], path)
    assert io.load_names(spark, path) == ["b", "a", "c"]
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "x int, z int")
    got = {(r["column"], r["side"]) for r in cl.schema_difference(spark, a, b).collect()}
    assert got == {("y", "missing_in_right"), ("z", "missing_in_left")}
    assert cl.dedupe_column_names(["a", "b", "a"]) == [0, 1]
    df = spark.createDataFrame([("k",), ("z",)], "c string")
    keep = [r["c"] for r in cl.lookup(df, "c", {"k": "K"}, keep_unmatched=True).collect()]
    drop = [r["c"] for r in cl.lookup(df, "c", {"k": "K"}, keep_unmatched=False).collect()]
    assert keep == ["K", "z"] and drop == ["K", None]


def _vectors(spark, extra=""):
    from pyspark.ml.feature import VectorAssembler

    rows = [(i // 2 if i < 20 else i, i % 3 + 1, float(i % 7), float(i * 13 % 11), float(i % 5), "x" * 5) for i in range(60)]
    df = spark.createDataFrame(rows, "uid long, fold int, a double, b double, label double, extra string")
    return VectorAssembler(inputCols=["a", "b"], outputCol=mo.FEATURES).transform(df)


def test_fold_models_score_unseen_rows_in_one_pass(spark):
    x = _vectors(spark)
    est = mo.make_regressor("forest", {"numTrees": 3}, 1)
    got = mo.fold_average_predict(x, x, est, "fold", ["uid"])
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    models = [est.fit(x.where(F.col("fold") != k)) for k in (1, 2, 3)]
    parts = [m.transform(x).select("uid", "prediction") for m in models]
    want = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("uid").agg(F.avg("prediction").alias("p"))
    both = got.join(want, "uid").collect()
    assert len(both) == got.count() == 50 and all(abs(r["predicted_score"] - r["p"]) < 1e-9 for r in both)


def test_search_fits_each_trial_and_fold_once(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    fits, fit = [], GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: fits.append(df.columns) or fit(self, df))
    space = mo.Space(ints={"maxDepth": (1, 3)})
    best, table = mo.random_search(_vectors(spark), "gbt_shallow", space, "fold", 2, 1, params={"maxIter": 2})
    assert len(fits) == 6 and all("extra" not in columns for columns in fits)
    scores = [r["score"] for r in table.orderBy("trial").collect()]
    trials = [space.sample(rng) for rng in [__import__("random").Random(1)] for _ in range(2)]
    assert best == trials[scores.index(min(scores))]


def test_out_of_fold_fits_read_only_their_columns(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressor

    fits, fit = [], RandomForestRegressor._fit
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda self, df: fits.append(df.columns) or fit(self, df))
    oof = mo.oof_predict(_vectors(spark), mo.make_regressor("forest", {"numTrees": 2}, 1), "fold", ["uid"])
    assert oof.count() == 60
    assert len(fits) == 3 and all(sorted(c) == ["features", "fold", "label", "uid"] for c in fits)
