"""Model plans (M1–M9, M12, M13, C6): row-count checks plus invariants in tests.

The modelling table joins the label stand-in to the encoded wide features,
so each fit's input grows with the test tables.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import blend as bl
from ..operators import clean as cl
from ..operators import features as fe
from ..operators import folds as fo
from ..operators import models as mo
from ..operators import penalty as pn
from ..operators import reshape as rs
from ..operators import scenarios as sc
from ..operators.quantiles import exact_quantiles_many
from ..session import checkpoint, ensure_checkpoint_dir
from .fixtures import fixture, with_fixtures
from .q_features import AGE_BANDS, PRIORITY_ORDER
from .q_folds import _md5_bucket_sql
from .registry import register

NUMERIC = ["glob_hlth_03", "glob_hlth_12", "hincome_03", "hincome_12", "n_orders_03", "n_orders_12",
           "narrowed_age_12", "glob_hlth_diff", "hincome_diff", "n_orders_diff", "bmi_12", "year"]
CATEGORICAL = ["edu_gru_12"]
KEYS = ["uid", "year"]


def encoded_features(f: DataFrame) -> DataFrame:
    """The reference's preprocessing order on the wide stand-in: narrow age, ordinal
    codes, wave differences, log incomes."""
    f = cl.narrow_age(f, "glob_hlth_03", "glob_hlth_12", AGE_BANDS, 9.0)
    f = cl.ordinal_encode(f, PRIORITY_ORDER)
    f = fe.wave_differences(f)
    return fe.log_columns(f)


def model_table(spark, sf_dir) -> tuple[DataFrame, list]:
    lab = fixture(spark, sf_dir, "f_labels")
    f = encoded_features(fixture(spark, sf_dir, "f_features"))
    x = lab.join(f, "uid", "left").withColumn("label", F.col("composite_score"))
    x = fo.kfold(x, "uid", 5, 42, out="fold")
    # materialise the joined rows once: the imputer, the indexer and every fold
    # fit read this table instead of re-running the joins
    x = checkpoint(mo.prepare_inputs(x, NUMERIC, CATEGORICAL))
    stages, slots = mo.assembler_stages(x, NUMERIC, CATEGORICAL)
    prep = Pipeline(stages=stages).fit(x)
    return prep.transform(x), slots


@register("oof_predictions")
def oof_predictions(spark, sf_dir):
    x, _ = model_table(spark, sf_dir)
    est = mo.make_regressor("gbt_shallow", {"maxIter": 10}, 42)
    return mo.oof_predict(x, est, "fold", KEYS)


@register("multi_seed_predictions")
def multi_seed_predictions(spark, sf_dir):
    """Long ``(uid, year, model, seed, predicted_score)`` for two families × two seeds (M8)."""
    x, _ = model_table(spark, sf_dir)
    parts = []
    for kind in ("forest", "gbt_shallow"):
        for seed in (0, 1):
            est = mo.make_regressor(kind, {"maxIter": 8, "numTrees": 10}, seed)
            parts.append(mo.oof_predict(x, est, "fold", KEYS).select(
                *KEYS, F.lit(kind).alias("model"), F.lit(seed).alias("seed"), "predicted_score"))
    return rs.union_all(parts)


@register("change_model")
def change_model(spark, sf_dir):
    """Relative change predictor (M7): OOF for keys with both labels, full fit for the rest."""
    lab = checkpoint(fixture(spark, sf_dir, "f_labels"))
    pairs = cl.complete_pairs(lab)
    target = rs.pivot_change(lab).select("uid", F.col("composite_score_diff").alias("label"))
    f = encoded_features(fixture(spark, sf_dir, "f_features"))
    num = [c for c in NUMERIC if c != "year"]
    # materialise the joined rows once, as in `model_table`
    x = checkpoint(mo.prepare_inputs(f.join(target, "uid", "left"), num, CATEGORICAL))
    stages, _ = mo.assembler_stages(x, num, CATEGORICAL)
    x = Pipeline(stages=stages).fit(x).transform(x).select("uid", "label", mo.FEATURES)
    train = checkpoint(fo.kfold(cl.semi_join(x, pairs).where(F.col("label").isNotNull()), "uid", 5, 42, out="fold1"))
    est = mo.make_regressor("gbt_shallow", {"maxIter": 10}, 42)
    oof, model = mo.oof_and_full(train, est, "fold1", ["uid"], out="composite_score_diff")
    rest = cl.anti_join(x, train.select("uid"))
    full = model.transform(rest).select(
        "uid", F.lit(0).alias("fold1"), F.lit(None).cast("double").alias("label"),
        F.col("prediction").alias("composite_score_diff"))
    return oof.unionByName(full)


@register("class_probabilities")
def class_probabilities(spark, sf_dir):
    x, _ = model_table(spark, sf_dir)
    return mo.class_probabilities(x, "composite_score", 10, "fold", KEYS, 42)


@register("importance_select")
def importance_select(spark, sf_dir):
    x, slots = model_table(spark, sf_dir)
    est = mo.make_regressor("gbt_shallow", {"maxIter": 10}, 42)
    return mo.fold_importance(x, est, "fold", slots)


@register("random_search")
def random_search(spark, sf_dir):
    x, _ = model_table(spark, sf_dir)
    space = mo.Space(ints={"maxDepth": (2, 4), "maxIter": (5, 10)}, floats={"stepSize": (0.05, 0.3)})
    _, table = mo.random_search(x, "gbt_shallow", space, "fold", n_trials=5, seed=42)
    return table


@register("lasso_stack")
def lasso_stack(spark, sf_dir):
    """L1 stack over pivoted OOF base predictions with quantile imputation (M9)."""
    x, _ = model_table(spark, sf_dir)
    base = []
    for kind in ("forest", "gbt_shallow"):
        est = mo.make_regressor(kind, {"maxIter": 8, "numTrees": 10}, 42)
        base.append(mo.oof_predict(x, est, "fold", KEYS).select(
            *KEYS, "label", F.col("predicted_score").alias(f"composite_score_{kind}")))
    wide = base[0].join(base[1].drop("label"), KEYS)
    cols = ["composite_score_forest", "composite_score_gbt_shallow"]
    fills = cl.fit_fill_quantile(wide, cols, 0.5)
    wide = cl.fill_values(wide, fills)
    wide = VectorAssembler(inputCols=cols, outputCol=mo.FEATURES).transform(wide)
    lasso = mo.make_regressor("lasso", {"regParam": 0.5}, 42)
    pred = lasso.fit(wide).transform(wide)
    return pred.select(*KEYS, "label", bl.directed_round("prediction").alias("composite_score_linear1"))


# What the path plans solve: two features with nulls, at fills and penalties that keep and that drop them.
PATH_COLUMNS, PATH_QUANTILES, PATH_PENALTIES = ("hincome_12", "n_orders_12"), (0.25, 0.5), (0.0, 0.5, 50.0)

# One feature's lasso is its covariance with the label, shrunk, over its variance; two features without a penalty are Cramer's rule.
PATH_SQL = f"""
WITH x AS (SELECT {_md5_bucket_sql(5, "l.uid", "42")} AS fold, l.composite_score AS y, CAST(f.hincome_12 AS DOUBLE) AS a, CAST(f.n_orders_12 AS DOUBLE) AS b
           FROM f_labels l LEFT JOIN f_features f ON l.uid = f.uid),
q AS (SELECT unnest([0.25, 0.5]) AS quantile, unnest(quantile_cont(a, [0.25, 0.5])) AS qa, unnest(quantile_cont(b, [0.25, 0.5])) AS qb FROM x),
z AS (SELECT fold, y, quantile, coalesce(a, qa) AS a, coalesce(b, qb) AS b FROM x, q),
folds AS (SELECT DISTINCT fold AS held FROM x),
m AS (SELECT held, quantile, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS va, var_pop(b) AS vb,
             covar_pop(a, y) AS ca, covar_pop(b, y) AS cb, covar_pop(a, b) AS ab
      FROM z, folds WHERE fold <> held GROUP BY held, quantile),
models AS (
  SELECT 'hincome_12' AS features, penalty, held, quantile, sign(ca) * greatest(abs(ca) - penalty, 0) / va AS wa, CAST(0 AS DOUBLE) AS wb, my, ma, mb
  FROM m, (VALUES (0.0), (0.5), (50.0)) p(penalty)
  UNION ALL SELECT 'n_orders_12', penalty, held, quantile, 0, sign(cb) * greatest(abs(cb) - penalty, 0) / vb, my, ma, mb
  FROM m, (VALUES (0.0), (0.5), (50.0)) p(penalty)
  UNION ALL SELECT 'hincome_12 n_orders_12', 0.0, held, quantile, (ca * vb - cb * ab) / (va * vb - ab * ab), (cb * va - ca * ab) / (va * vb - ab * ab), my, ma, mb FROM m)
SELECT features, CAST(penalty AS DOUBLE) AS penalty, CAST(models.quantile AS DOUBLE) AS quantile, CAST(held AS BIGINT) AS fold,
       round(any_value(wa), 6) AS w_income, round(any_value(wb), 6) AS w_orders, round(any_value(my - wa * ma - wb * mb), 6) AS intercept,
       count(*) AS n_held, round(sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2)), 6) AS rmse_held
FROM models JOIN z ON z.fold = models.held AND z.quantile = models.quantile GROUP BY features, penalty, models.quantile, held"""


@register("penalty_path", with_fixtures(PATH_SQL, "f_labels", "f_features"))
def penalty_path(spark, sf_dir):
    """Lasso models of every fold, fill and penalty from one scan's cross products (M9)."""
    x = fixture(spark, sf_dir, "f_labels").join(fixture(spark, sf_dir, "f_features"), "uid", "left")
    x = checkpoint(fo.kfold(x.select("uid", F.col("composite_score").alias("label"), *PATH_COLUMNS), "uid", 5, 42, out="fold"))
    fills = exact_quantiles_many(x, list(PATH_COLUMNS), list(PATH_QUANTILES))
    found = pn.moments(x, PATH_COLUMNS, "fold", centers=[fills[c][-1] for c in PATH_COLUMNS])
    rows = []
    for i, quantile in enumerate(PATH_QUANTILES):
        for columns, penalties in ([(c,), PATH_PENALTIES] for c in PATH_COLUMNS):
            rows += [(" ".join(columns), quantile, m) for m in pn.path(found, penalties, [fills[c][i] for c in PATH_COLUMNS], columns)]
        rows += [(" ".join(PATH_COLUMNS), quantile, m) for m in pn.path(found, [0.0], [fills[c][i] for c in PATH_COLUMNS])]
    # a row for each model
    return spark.createDataFrame([
        (name, m.penalty, quantile, m.fold, *(round(m.coefficients.get(c, 0.0), 6) + 0.0 for c in PATH_COLUMNS), round(m.intercept, 6),
         m.held_rows, round((m.held_error / m.held_rows) ** 0.5, 6)) for name, quantile, m in rows],
        "features string, penalty double, quantile double, fold long, w_income double, w_orders double, intercept double, n_held long, rmse_held double")


@register("weighted_refit")
def weighted_refit(spark, sf_dir):
    """Refit with per-group weights softmax(+RMSE/10) of a first model's errors."""
    x, _ = model_table(spark, sf_dir)
    est = mo.make_regressor("gbt_shallow", {"maxIter": 8}, 42)
    oof = mo.oof_predict(x, est, "fold", KEYS)
    grp = x.select(*KEYS, F.coalesce(F.col("edu_gru_12"), F.lit("missing")).alias("group"))
    g = oof.join(grp, KEYS).withColumn("model", F.lit("first"))
    w = bl.group_rmse_weights(g, "model", "group", "predicted_score", "label", temperature=10.0, sign=1.0)
    xw = x.withColumn("group", F.coalesce(F.col("edu_gru_12"), F.lit("missing"))) \
        .join(w.select("group", F.col("weight").alias("w")), "group", "left")
    wm = mo.make_regressor("gbt_shallow", {"maxIter": 8}, 42, weight="w")
    return mo.oof_predict(xw, wm, "fold", KEYS)


@register("score_saved_model")
def score_saved_model(spark, sf_dir):
    """Fit a pipeline, save it under the checkpoint folder, load it and score."""
    lab = fixture(spark, sf_dir, "f_labels")
    f = encoded_features(fixture(spark, sf_dir, "f_features"))
    x = mo.prepare_inputs(lab.join(f, "uid", "left").withColumn("label", F.col("composite_score")),
                          NUMERIC, CATEGORICAL)
    stages, _ = mo.assembler_stages(x, NUMERIC, CATEGORICAL)
    model = mo.fit_pipeline(x, stages, mo.make_regressor("forest", {"numTrees": 10}, 42))
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    mo.save_model(model, path)
    return mo.predict(mo.load_model(path), x, KEYS)


@register("score_scenarios")
def score_scenarios(spark, sf_dir):
    """Score every counterfactual scenario with one fitted model; mean per scenario and year."""
    lab = fixture(spark, sf_dir, "f_labels")
    raw = fixture(spark, sf_dir, "f_features")
    train = mo.prepare_inputs(lab.join(encoded_features(raw), "uid", "left")
                              .withColumn("label", F.col("composite_score")), NUMERIC, CATEGORICAL)
    stages, _ = mo.assembler_stages(train, NUMERIC, CATEGORICAL)
    model = mo.fit_pipeline(train, stages, mo.make_regressor("forest", {"numTrees": 10}, 42))
    cat = sc.filter_catalogue(sc.catalogue(raw.select("uid", "glob_hlth_03", "glob_hlth_12", "edu_gru_12"),
                                           "uid"), ("age",), 100)
    # the join by key comes before the scenarios, which change no key; only rows that a scenario changes are scored again
    rows, table = lab.select("uid", "year").join(raw, "uid"), sc.valid_table(raw, sc.scenario_table(cat))

    def score(x):
        scored = model.transform(mo.prepare_inputs(encoded_features(
            x.withColumns({f"_raw_{c}": F.col(c) for c in raw.columns})), NUMERIC, CATEGORICAL))
        return scored.withColumns({c: F.col(f"_raw_{c}") for c in raw.columns})

    return sc.delta_means(rows, table, score)


@register("stream_score_scenarios")
def stream_score_scenarios(spark, sf_dir):
    """Scenario rows written as files, scored by a file-source stream, summarised per scenario."""
    from ..streaming.scoring import score_files
    lab = fixture(spark, sf_dir, "f_labels")
    raw = fixture(spark, sf_dir, "f_features")
    train = mo.prepare_inputs(lab.join(encoded_features(raw), "uid", "left")
                              .withColumn("label", F.col("composite_score")), NUMERIC, CATEGORICAL)
    stages, _ = mo.assembler_stages(train, NUMERIC, CATEGORICAL)
    model = mo.fit_pipeline(train, stages, mo.make_regressor("forest", {"numTrees": 10}, 42))
    cat = sc.filter_catalogue(sc.catalogue(raw.select("uid", "glob_hlth_12", "edu_gru_12"), "uid"), ("age",), 100)
    scen = sc.override(lab.select("uid", "year").join(raw, "uid"), sc.split_valid(raw, sc.scenarios_from(cat))[0])
    base = f"{ensure_checkpoint_dir(spark)}/stream/{uuid.uuid4().hex}"
    scen.write.mode("overwrite").partitionBy("feature_category").parquet(f"{base}/in")
    # explicit schemas: an empty scenario list must give an empty result, not a failed inference
    in_schema = T.StructType([f for f in scen.schema.fields if f.name != "feature_category"]
                             + [scen.schema["feature_category"]])
    prepare = lambda d: mo.prepare_inputs(encoded_features(d), NUMERIC, CATEGORICAL)
    score_files(spark, f"{base}/in", in_schema, model, KEYS, f"{base}/out", f"{base}/_ckpt", prepare=prepare)
    out_schema = model.transform(prepare(scen.where(F.lit(False)))).select(
        *KEYS, F.col("prediction").alias("predicted_score"), "feature_category").schema
    out = spark.read.schema(out_schema).parquet(f"{base}/out")
    return out.groupBy("feature_category", "year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("predicted_score").alias("mean_predicted"))


@register("fold_average_unseen")
def fold_average_unseen(spark, sf_dir):
    """Mean of the k fold models' predictions for customers without labels."""
    from .q_specs import fixture_inputs
    x, _ = model_table(spark, sf_dir)
    _, _, test_f, test_keys = fixture_inputs(spark, sf_dir)
    unseen = test_keys.join(encoded_features(test_f), "uid")
    # the joins run once, before the models; nothing of them is left in the stage that scores and averages
    unseen = checkpoint(mo.prepare_inputs(unseen, NUMERIC, CATEGORICAL))
    stages, _ = mo.assembler_stages(unseen, NUMERIC, CATEGORICAL)
    # the assembler's imputation medians come from the training rows
    prep = Pipeline(stages=stages).fit(x.select(*NUMERIC, *[f"{c}__str" for c in CATEGORICAL]))
    est = mo.make_regressor("forest", {"numTrees": 10}, 42)
    return mo.fold_average_predict(x, prep.transform(unseen), est, "fold", KEYS)


@register("gbt_early_stopping")
def gbt_early_stopping(spark, sf_dir):
    """Boosting with one fold as validation set and early stopping."""
    x, _ = model_table(spark, sf_dir)
    x = x.withColumn("is_valid", F.col("fold") == 5)
    est = mo.make_regressor("gbt_deep", {"maxIter": 40, "stepSize": 0.3}, 42, validation="is_valid")
    m = est.fit(x)
    return m.transform(x).select(*KEYS, "is_valid", F.col("prediction").alias("predicted_score"),
                                 F.lit(m.getNumTrees).alias("n_trees"))
