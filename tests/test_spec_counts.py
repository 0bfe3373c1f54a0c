"""What the registered specifications run, and what their boosted trees are fitted on."""

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from wavefold.operators import models as mo
from wavefold.plans import q_specs as qs
from wavefold.plans import runner as rn


def test_registered_specifications_run_the_whole_counts(monkeypatch):
    """Five seeds, five trials and the families' own sizes, not a smaller job."""
    monkeypatch.setattr(qs, "fixture_inputs", lambda spark, sf_dir: ())
    monkeypatch.setattr(qs, "run_spec", lambda spark, *inputs, cfg, spec: spec)
    for plan in (qs.spec_full, qs.spec_perturbed):
        spec = plan(None, "")
        assert (spec.n_seeds, spec.n_trials, spec.k, dict(spec.model_params)) == (5, 5, 5, {})
        assert list(spec.models) == ["gbt_deep", "gbt_shallow", "forest"]
    assert qs.spec_full(None, "").change and qs.spec_full(None, "").class_probs
    assert qs.spec_perturbed(None, "").drop_fraction == 0.5 and qs.spec_perturbed(None, "").winsorize


def test_boosted_trees_are_the_same_without_constant_slots(spark):
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), F.lit(3.0).alias("same"),
                                   F.when(F.col("id") % 5 != 0, F.col("id") % 11).cast("double").alias("b"),
                                   (F.col("id") * 37 % 101).cast("double").alias("label"))
    cols = ["a", "same", "b"]
    prep = rn._mark_varying(rn._fit_assembler(rows, cols), rows, cols)
    assert rn._varying_slots(prep, rn._slots(rows, cols)) == ["a__imp", "b__imp", "b__missing"]
    x = rn._assemble_with(prep, rows, cols).cache()
    est = mo.make_regressor("gbt_deep", {"maxIter": 3}, 1)
    whole = est.fit(x)
    narrow = est.fit(x.drop(mo.FEATURES).withColumnRenamed(rn.VARYING, mo.FEATURES)).setFeaturesCol(rn.VARYING)
    both = narrow.setPredictionCol("n").transform(whole.transform(x))
    assert both.where(F.col("n") != F.col("prediction")).count() == 0 and both.select("n").distinct().count() > 5


def test_a_table_without_varying_slots_keeps_one(spark):
    rows = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    x = rn._assemble_with(rn._mark_varying(rn._fit_assembler(rows, ["a"]), rows, ["a"]), rows, ["a"])
    assert x.first()[rn.VARYING] == Vectors.dense([1.0])
