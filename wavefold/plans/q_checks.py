"""Checks of the model plans whose answers SQL can state."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..operators import features as fe
from ..operators import models as mo
from . import q_models as qm
from . import q_specs as qs
from .fixtures import fixture, with_fixtures
from .q_folds import _md5_bucket_sql
from .q_scenarios import _clean_sql
from .registry import register

FOLD = _md5_bucket_sql(5, "uid", "42")
LABELS = ("f_labels",)


def _n(*keys):
    return lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@register("check_oof_rows", with_fixtures(f"""
SELECT {FOLD} AS fold, year, count(*) AS n, CAST(0 AS BIGINT) AS n_null FROM f_labels GROUP BY 1, 2""", *LABELS))
def check_oof_rows(spark, sf_dir):
    """Every row is predicted once, by the models of the other folds."""
    oof = qm.oof_predictions(spark, sf_dir)
    return oof.groupBy("fold", F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted_score").isNull()).alias("n_null"))


@register("check_oof_error", with_fixtures("""
SELECT model, true AS within_a_tenth_of_mean, count(*) AS n FROM f_labels, (VALUES ('gbt_shallow'), ('forest')) m(model) GROUP BY model""", *LABELS))
def check_oof_error(spark, sf_dir):
    """The out-of-fold error of each family is at most a tenth above that of the mean score (M1, M3)."""
    x, _ = qm.model_table(spark, sf_dir)
    parts = [mo.oof_predict(x, mo.make_regressor(k, {"maxIter": 10, "numTrees": 10}, 42), "fold", qm.KEYS)
             .withColumn("model", F.lit(k)) for k in ("gbt_shallow", "forest")]
    return parts[0].unionByName(parts[1]).groupBy("model").agg(
        (F.sqrt(F.avg(F.pow(F.col("predicted_score") - F.col("label"), 2))) < 1.1 * F.stddev_pop("label")).alias("within_a_tenth_of_mean"),
        F.count(F.lit(1)).alias("n"))


@register("check_seed_rows", with_fixtures("""
SELECT model, seed, count(*) AS n FROM f_labels, (VALUES ('forest'), ('gbt_shallow')) m(model), (VALUES (0), (1)) s(seed)
GROUP BY model, seed""", *LABELS))
def check_seed_rows(spark, sf_dir):
    """Each family and seed predicts every label row (M8)."""
    return _n("model", "seed")(qm.multi_seed_predictions(spark, sf_dir))


@register("check_change_rows", with_fixtures(f"""
WITH p AS (SELECT uid, max(CASE WHEN year = 2021 THEN composite_score END) AS b FROM f_labels GROUP BY uid HAVING count(*) = 2)
SELECT CAST(CASE WHEN p.b <> 0 THEN {FOLD.replace("uid", "f.uid")} ELSE 0 END AS INTEGER) AS fold1, count(*) AS n
FROM f_features f LEFT JOIN p ON f.uid = p.uid GROUP BY 1""", "f_labels", "f_features"))
def check_change_rows(spark, sf_dir):
    """Keys with both years are predicted out of fold, all others by the full fit, fold 0 (M7)."""
    return _n("fold1")(qm.change_model(spark, sf_dir))


@register("check_class_probabilities", with_fixtures("""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_off, CAST(0 AS BIGINT) AS n_negative FROM f_labels""", *LABELS))
def check_class_probabilities(spark, sf_dir):
    """Ten probabilities a row that sum to one (M6)."""
    p = qm.class_probabilities(spark, sf_dir)
    cols = [F.col(f"quantile_{i}_10") for i in range(10)]
    total = sum(cols, F.lit(0.0))
    return p.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(total - 1) > 1e-6).alias("n_off"),
                 F.count_if(F.least(*cols) < 0).alias("n_negative"))


@register("check_importance", with_fixtures("""
SELECT 100.0 AS total, CAST(0 AS BIGINT) AS n_negative, count(*) > 0 AS rows_read FROM f_labels""", *LABELS))
def check_importance(spark, sf_dir):
    """Importances of all folds sum to 100 on average (M5, A4)."""
    imp = qm.importance_select(spark, sf_dir)
    return imp.agg(F.round(F.sum("importance"), 4).alias("total"), F.count_if(F.col("importance") < -1e-12).alias("n_negative"),
                   (F.count(F.lit(1)) > 0).alias("rows_read")).withColumn("total", F.col("total").cast("decimal(4,1)"))


@register("feature_table", with_fixtures("""
WITH v AS (SELECT 'edu_gru_12' AS feature, coalesce(edu_gru_12, 'nan') AS category FROM f_labels l LEFT JOIN f_features f ON l.uid = f.uid
           UNION ALL SELECT 'bmi_12', coalesce(CAST(CAST(bmi_12 AS DOUBLE) AS VARCHAR), 'nan') FROM f_labels l LEFT JOIN f_features f ON l.uid = f.uid)
SELECT feature, category, count(*) AS n, true AS has_importance FROM v GROUP BY feature, category""", "f_labels", "f_features"))
def feature_table(spark, sf_dir):
    """Mean importance of each feature beside the counts of its values."""
    x, slots = qm.model_table(spark, sf_dir)
    est = mo.make_regressor("gbt_shallow", {"maxIter": 10}, 42)
    imp = mo.fold_importance(x, est, "fold", slots)
    base = imp.groupBy(mo.source_column("feature").alias("Feature")).agg(F.sum("importance").alias("importance"))
    chosen = mo.select_features(imp, threshold=-1.0)
    cols = [c for c in ("edu_gru_12", "bmi_12") if c in chosen]
    counts = fe.value_counts_long(x, cols)
    return counts.join(base, "Feature", "left").select(
        F.col("Feature").alias("feature"), F.col("Categories").alias("category"), F.col("N").alias("n"),
        F.col("importance").isNotNull().alias("has_importance"))


@register("check_random_search", with_fixtures("""
SELECT t.trial, true AS scored FROM (VALUES (0), (1), (2), (3), (4)) t(trial) WHERE (SELECT count(*) FROM f_labels) > 0""", *LABELS))
def check_random_search(spark, sf_dir):
    """Every trial of the search has a score (M4)."""
    return qm.random_search(spark, sf_dir).select("trial", (F.col("score") > 0).alias("scored"))


@register("check_lasso_stack", with_fixtures("""
SELECT year, count(*) AS n, CAST(0 AS BIGINT) AS n_off FROM f_labels GROUP BY year""", *LABELS))
def check_lasso_stack(spark, sf_dir):
    """A stacked whole-number score for every label row."""
    s = qm.lasso_stack(spark, sf_dir)
    v = F.col("composite_score_linear1")
    return s.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count_if(v.isNull() | (v != F.floor(v))).alias("n_off"))


@register("check_weighted_refit", with_fixtures(f"""
SELECT {FOLD} AS fold, count(*) AS n FROM f_labels GROUP BY 1""", *LABELS))
def check_weighted_refit(spark, sf_dir):
    return _n("fold")(qm.weighted_refit(spark, sf_dir))


@register("check_saved_model", with_fixtures("""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM f_labels""", *LABELS))
def check_saved_model(spark, sf_dir):
    """A model that was saved and loaded scores every row as the one in memory does."""
    import uuid

    from ..session import ensure_checkpoint_dir
    x, _ = qm.model_table(spark, sf_dir)
    model = mo.fit_pipeline(x, [], mo.make_regressor("forest", {"numTrees": 10}, 42))
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    mo.save_model(model, path)
    both = mo.predict(model, x, qm.KEYS, "a").join(mo.predict(mo.load_model(path), x, qm.KEYS, "b"), qm.KEYS)
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))


def _scenario_rows_sql(parts: str, least: int, keys: str) -> str:
    return with_fixtures(f"""
WITH st AS ({parts}),
cat AS (SELECT feature_name, category FROM st WHERE category IS NOT NULL GROUP BY 1, 2
        HAVING greatest(sum(w03), sum(w12)) > {least}),
k AS ({keys})
SELECT {_clean_sql("cat.feature_name || '@' || cat.category")} AS feature_category, k.year, count(*) AS n
FROM cat, k GROUP BY 1, 2""", "f_features", "f_labels")


_EDU = "SELECT 'edu_gru' AS feature_name, edu_gru_12 AS category, 0 AS w03, 1 AS w12 FROM f_features"
_H12 = "SELECT 'glob_hlth', glob_hlth_12, 0, 1 FROM f_features"
_H03 = "SELECT 'glob_hlth', glob_hlth_03, 1, 0 FROM f_features"


@register("check_scenario_scores", _scenario_rows_sql(f"{_EDU} UNION ALL {_H03} UNION ALL {_H12}", 100, "SELECT uid, year FROM f_labels"))
def check_scenario_scores(spark, sf_dir):
    """Every label row is scored under every scenario."""
    return qm.score_scenarios(spark, sf_dir).select("feature_category", F.col("year").cast("int").alias("year"), "n")


@register("check_stream_scores", _scenario_rows_sql(f"{_EDU} UNION ALL {_H12}", 100, "SELECT uid, year FROM f_labels"))
def check_stream_scores(spark, sf_dir):
    """The stream scores as many rows as there are scenario rows."""
    return qm.stream_score_scenarios(spark, sf_dir).select("feature_category", F.col("year").cast("int").alias("year"), "n")


@register("check_unseen_rows", with_fixtures("""
SELECT y.year, count(*) AS n, CAST(0 AS BIGINT) AS n_null FROM f_features f, (VALUES (2016), (2021)) y(year)
WHERE f.uid NOT IN (SELECT uid FROM f_labels) GROUP BY y.year""", "f_features", "f_labels"))
def check_unseen_rows(spark, sf_dir):
    """Each customer without labels gets the mean of the fold models for both years."""
    p = qm.fold_average_unseen(spark, sf_dir)
    return p.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("predicted_score").isNull()).alias("n_null"))


@register("check_early_stopping", with_fixtures(f"""
SELECT {FOLD} = 5 AS is_valid, count(*) AS n, true AS stopped FROM f_labels GROUP BY 1""", *LABELS))
def check_early_stopping(spark, sf_dir):
    """Boosting stops before its 40 rounds, watching one fold."""
    g = qm.gbt_early_stopping(spark, sf_dir)
    return g.groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"), (F.max("n_trees") < 40).alias("stopped"))


def _spec_rows_sql(models: str, train_filter: str = "", test_filter: str = "") -> str:
    return with_fixtures(f"""
WITH m AS (SELECT * FROM (VALUES {models}) t(model, seed))
SELECT 'train' AS dataset, year, model, seed, count(*) AS n FROM f_labels, m {train_filter} GROUP BY ALL
UNION ALL
SELECT 'test', y.year, model, seed, count(*) FROM f_features f, (VALUES (2016), (2021)) y(year), m
WHERE f.uid NOT IN (SELECT uid FROM f_labels) {test_filter} GROUP BY ALL""", "f_features", "f_labels")


_SPEC_MODELS = ("('gbt_deep', 0), ('forest', 0), ('gbt_shallow', 0), ('linear1', 0), ('blended', 0), ('final', NULL)")


@register("check_spec_rows", _spec_rows_sql(_SPEC_MODELS))
def check_spec_rows(spark, sf_dir):
    """A whole specification: every train and test row under every model."""
    return qs.one_seed(spark, sf_dir).groupBy("dataset", F.col("year").cast("int").alias("year"), "model", "seed").agg(F.count(F.lit(1)).alias("n"))


@register("check_bundle_scenarios", with_fixtures(f"""
WITH t AS (SELECT * FROM f_features WHERE uid NOT IN (SELECT uid FROM f_labels)),
st AS (SELECT 'edu_gru' AS feature_name, edu_gru_12 AS category FROM t UNION ALL SELECT 'glob_hlth', glob_hlth_12 FROM t),
cat AS (SELECT feature_name, category FROM st WHERE category IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 10)
SELECT {_clean_sql("cat.feature_name || '@' || cat.category")} AS feature_category, y.year, count(*) AS n
FROM cat, t, (VALUES (2016), (2021)) y(year) GROUP BY 1, 2""", "f_features", "f_labels"))
def check_bundle_scenarios(spark, sf_dir):
    """A saved and loaded bundle scores every scenario of the test customers."""
    return qs.spec_bundle_scenarios(spark, sf_dir).select("feature_category", F.col("year").cast("int").alias("year"), "n")
