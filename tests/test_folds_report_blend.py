"""Folds, report metrics, bootstrap and blending invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavefold.operators import blend as bl
from wavefold.operators import folds as fo
from wavefold.operators import report as rp
from wavefold.operators import scenarios as sc


def test_kfold_deterministic_and_balanced(spark):
    df = spark.range(0, 997).withColumnRenamed("id", "uid")
    a = {r["uid"]: r["fold"] for r in fo.kfold(df, "uid", 5, 42).collect()}
    b = {r["uid"]: r["fold"] for r in fo.kfold(df, "uid", 5, 42).collect()}
    assert a == b and set(a.values()) <= {1, 2, 3, 4, 5}
    bal = fo.kfold(df, "uid", 5, 42, balanced=True).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in bal)
    assert sizes[-1] - sizes[0] <= 1 and sum(sizes) == 997


def test_group_kfold_is_greedy_with_a_null_group(spark):
    rng = np.random.default_rng(3)
    values = [None, *(f"g{i}" for i in range(40))]
    rows = [(i, values[min(int(g), 40)]) for i, g in enumerate(rng.exponential(9, size=900))] + [(10_000 + i, f"s{i:03d}") for i in range(100)]
    got = {r["i"]: r["fold"] for r in fo.group_kfold(spark.createDataFrame(rows, "i int, g string"), "g", 4).collect()}
    sizes = {}
    for _, g in rows:
        sizes[g] = sizes.get(g, 0) + 1
    loads, want = [0] * 4, {}
    for g in sorted(sizes, key=lambda g: (-sizes[g], g is not None, g or "")):
        f = min(range(4), key=lambda x: (loads[x], x))
        loads[f] += sizes[g]
        want[g] = f + 1
    assert got == {i: want[g] for i, g in rows}


def test_group_kfold_keeps_groups_whole(spark):
    rows = [(i, g) for g, n in enumerate([30, 20, 10, 10, 5, 5, 3, 2, 1]) for i in range(n)]
    df = spark.createDataFrame(rows, "i int, g int")
    out = fo.group_kfold(df, "g", 3)
    per_group = out.groupBy("g").agg(F.countDistinct("fold").alias("k")).collect()
    assert all(r["k"] == 1 for r in per_group)
    loads = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert loads == [28, 28, 30]   # greedy: 30 | 20+5+3 | 10+10+5+2+1


def test_combined_fold_zero_for_missing(spark):
    rows = spark.createDataFrame([(1, 2016), (1, 2021), (2, 2016)], "uid int, year int")
    f1 = spark.createDataFrame([(1, 3)], "uid int, fold1 int")
    got = {(r["uid"], r["year"]): r["combined_fold"] for r in fo.combined_fold(rows, f1).collect()}
    assert got[(2, 2016)].startswith("0_") and got[(1, 2016)].startswith("3_")


def test_rmse_and_fairness(spark):
    rows = [("a", 1.0, 0.0), ("a", 3.0, 0.0), ("b", 2.0, 0.0)]
    df = spark.createDataFrame(rows, "g string, predicted_score double, composite_score double") \
        .withColumn("model", F.lit("m"))
    r = {x["group"]: x["rmse"] for x in rp.rmse_by_groups(df, ["g"]).collect()}
    assert math.isclose(r["a"], math.sqrt(5)) and r["b"] == 2.0
    fair = rp.fairness(rp.rmse_by_groups(df, ["g"])).first()["fairness"]
    assert math.isclose(fair, 1 - (math.sqrt(5) - 2) / math.sqrt(5))


def test_poisson_bootstrap_se_close_to_analytic(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(10, 5, size=2000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "id int, v double") \
        .withColumn("g", F.lit("all"))
    r = rp.bootstrap_se(df, "v", ["g"], ["id"], n_boot=200, seed=1).first()
    analytic = x.std(ddof=1) / math.sqrt(len(x))
    assert abs(r["se"] - analytic) / analytic < 0.25
    th = rp.poisson1_thresholds()
    assert all(a < b for a, b in zip(th, th[1:])) and th[-1] > 0.999999


def test_blend_weights_and_bounds(spark):
    rows = []
    for uid in range(40):
        cat = "x" if uid % 2 else "y"
        truth = float(uid)
        rows += [(uid, 2016, cat, "good", truth + 0.5, truth), (uid, 2016, cat, "bad", truth + 4.0, truth)]
    df = spark.createDataFrame(rows, "uid int, year int, category string, model string, "
                                     "predicted_score double, composite_score double")
    w = bl.group_rmse_weights(df)
    sums = [r["s"] for r in w.groupBy("category").agg(F.sum("weight").alias("s")).collect()]
    assert all(abs(s - 1) < 1e-12 for s in sums)
    good = {r["category"]: r["weight"] for r in w.where(F.col("model") == "good").collect()}
    assert all(v > 0.9 for v in good.values())
    b = bl.blend(df, w).join(df.groupBy("uid", "year").agg(F.min("predicted_score").alias("lo"),
                                                           F.max("predicted_score").alias("hi")), ["uid", "year"])
    assert b.where((F.col("blended_score") < F.col("lo") - 1e-9) | (F.col("blended_score") > F.col("hi") + 1e-9)).count() == 0


def test_finalize_and_directed_round(spark):
    df = spark.createDataFrame([(1, 2016, 0, 10.2), (1, 2016, 1, 10.9)], "uid int, year int, seed int, blended_score double")
    assert bl.finalize(df).first()["composite_score"] == 11.0
    x = spark.createDataFrame([(1000.5,), (999.2,)], "p double")
    assert [r[0] for r in x.select(bl.directed_round("p")).collect()] == [1000.0, 1000.0]


def test_scenario_override_only_non_null(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b")], "uid int, f_03 string, f_12 string")
    scen = [sc.Scenario("f", "z z.(1)", True, True)]
    out = {r["uid"]: (r["f_03"], r["f_12"], r["feature_category"]) for r in sc.override(df, scen).collect()}
    assert out == {1: ("z z.(1)", None, "f@z_z_1"), 2: (None, "z z.(1)", "f@z_z_1")}


def test_catalogue_counts(spark):
    df = spark.createDataFrame([(1, "a", "a", "s"), (2, "b", "a", None)], "uid int, f_03 string, f_12 string, st string")
    got = {(r["feature_name"], r["category"]): (r["year_03"], r["year_12"], r["count_03"], r["count_12"], r["count"])
           for r in sc.catalogue(df).collect()}
    assert got == {("f", "a"): (True, True, 1, 2, None), ("f", "b"): (True, True, 1, 0, None),
                   ("st", "s"): (False, False, 0, 0, 1)}


def test_zero_denominators_give_null(spark):
    # one-row group: some Poisson replicates draw it zero times
    df = spark.createDataFrame([(1, 5.0, "g")], "id int, v double, g string")
    r = rp.bootstrap_se(df, "v", ["g"], ["id"], n_boot=30, seed=3).first()
    assert r["mean"] == 5.0 and (r["se"] is None or r["se"] == 0.0)
    z = spark.createDataFrame([("a", 0.0, 0.0, "m")], "group string, predicted_score double, composite_score double, model string")
    assert rp.fairness(rp.rmse_by_groups(z, ["group"])).first()["fairness"] is None
    assert spark.range(1).select(rp.percent_change(F.lit(1.0), F.lit(0.0)).alias("p")).first()["p"] is None


def test_no_scenarios_gives_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "uid int, f_12 string")
    out = sc.override(df, [])
    assert out.count() == 0 and "feature_category" in out.columns
    assert sc.median_shift(df, ["hincome"]).count() == 0


def test_replicates_are_the_weights_that_the_expressions_draw(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, rng.random() * 100])) for i in range(700)]
    rows += [(i, "all null", 1, None) for i in range(3)] + [(9000, "one", 1, 7.0)]
    df = spark.createDataFrame(rows, "id long, g string, h int, v double").repartition(5)
    got = {(r.g, r.h, r.b): r.mean_b for r in rp.bootstrap_replicates(df, "v", ["g", "h"], ["id"], n_boot=40, seed=3).collect()}
    x = df.select("g", "h", "v", *rp.replicate_hashes("id", seed=3)).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(39))))
    x = x.withColumn("w", rp.poisson_weight(rp.replicate_uniform("_h1", "_h2", "b")))
    want = {(r.g, r.h, r.b): r.m for r in x.groupBy("g", "h", "b").agg(F.try_divide(F.sum(F.col("w") * F.col("v")), F.sum("w")).alias("m")).collect()}
    assert got.keys() == want.keys()
    assert all(want[k] is None and v is None or v == pytest.approx(want[k], rel=1e-12) for k, v in got.items())


def test_replicates_of_many_groups_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(rp, "BOOT_GROUPS", 7)
    df = spark.createDataFrame([(i, i % 50, float(i)) for i in range(300)], "id long, g long, v double")
    assert rp.bootstrap_se(df, "v", ["g"], ["id"], n_boot=20).count() == 50
    assert rp.bootstrap_replicates(df, "v", [], ["id"], n_boot=20).count() == 20
    assert rp.bootstrap_replicates(df.limit(0), "v", ["g"], ["id"], n_boot=20).count() == 0
