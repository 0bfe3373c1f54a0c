"""Model operators on Spark MLlib.

* Inputs are assembled once into a vector column: per-column median
  imputation plus a 0/1 missing flag (MLlib trees reject NaN/NULL, the
  boosting libraries of the reference accept them), optional string indexing
  of categoricals with NULL as its own category.
* Out-of-fold fits filter one persisted table by a fold column; it holds only the
  keys, the folds and what the estimator reads. The fits are independent distributed
  jobs, submitted from a small driver thread pool, fewer at once the larger the table.
* Hyperparameter search is a seeded random search; every trial is fitted without
  and scored on each fold, the same md5 folds as everywhere else.
* Predictions stay long: ``(keys…, model, seed, predicted_score)``.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import qcut

FEATURES = "features"
#: Cells (rows times vector slots) of the fits that run at once: each keeps its binned rows while it runs.
CELLS_AT_ONCE = 500_000_000
#: Fits at once, whatever their size.
FITS_AT_ONCE = (2, 8)


# ------------------------------------------------------------------ assembly

def assembler_stages(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                     impute: bool = True) -> tuple[list, list[str]]:
    """Stages that turn raw columns into one vector column and the slot names.

    Numeric: median imputation + ``{c}__missing`` flag. Categorical: NULL →
    ``missing`` and ``StringIndexer(handleInvalid='keep')`` (M18).
    """
    stages, slots = [], []
    num = [c for c in numeric if c in df.columns]
    if impute and num:
        stages.append(Imputer(inputCols=num, outputCols=[f"{c}__imp" for c in num], strategy="median"))
        slots += [f"{c}__imp" for c in num] + [f"{c}__missing" for c in num]
    else:
        slots += num
    cats = [c for c in categorical if c in df.columns]
    if cats:
        stages.append(StringIndexer(inputCols=[f"{c}__str" for c in cats],
                                    outputCols=[f"{c}__idx" for c in cats], handleInvalid="keep"))
        slots += [f"{c}__idx" for c in cats]
    stages.append(VectorAssembler(inputCols=slots, outputCol=FEATURES, handleInvalid="keep"))
    return stages, slots


def prepare_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Cast numerics to double, add missing flags and string forms of categoricals."""
    out = df.withColumns({c: F.col(c).cast("double") for c in numeric if c in df.columns})
    out = out.withColumns({f"{c}__missing": F.col(c).isNull().cast("double") for c in numeric if c in df.columns})
    return out.withColumns({f"{c}__str": F.coalesce(F.col(c).cast("string"), F.lit("missing"))
                            for c in categorical if c in df.columns})


# ---------------------------------------------------------------- estimators

#: Model families: the estimator and the parameters it is given unless a caller names others.
FAMILIES = {
    "gbt_deep": (GBTRegressor, {"maxDepth": 5, "maxIter": 20, "stepSize": 0.1, "subsamplingRate": 0.8}),
    "gbt_shallow": (GBTRegressor, {"maxDepth": 3, "maxIter": 30, "stepSize": 0.05, "minInstancesPerNode": 5}),
    "forest": (RandomForestRegressor, {"numTrees": 30, "maxDepth": 6}),
    "lasso": (LinearRegression, {"elasticNetParam": 1.0, "regParam": 0.1, "standardization": False}),
}


def make_regressor(kind: str, params: dict | None = None, seed: int = 42, label: str = "label",
                   weight: str | None = None, validation: str | None = None, validation_tol: float = 0.01):
    """One factory for the three tree families and the L1 stack.

    ``validation`` names a boolean column marking held-out rows: boosted trees
    then stop early when the validation error stops improving (M17).
    """
    try:
        family, defaults = FAMILIES[kind]
    except KeyError:
        raise ValueError(f"unknown model family {kind!r}; there are {', '.join(FAMILIES)}") from None
    given = {k: v for k, v in (params or {}).items() if k in defaults}
    est = family(labelCol=label, featuresCol=FEATURES, **(defaults | given))
    if est.hasParam("seed"):
        est.set(est.getParam("seed"), seed)
    if weight is not None:
        est.setWeightCol(weight)
    if validation is not None:
        if not isinstance(est, GBTRegressor):
            raise ValueError("validation-based early stopping needs a boosted-tree regressor")
        est.setParams(validationIndicatorCol=validation, validationTol=validation_tol)
    return est


# ------------------------------------------------------------- out-of-fold

def _fold_values(df: DataFrame, fold: str) -> list:
    # one row per fold: bounded by k
    return sorted(r[0] for r in df.select(fold).distinct().collect())


def fit_columns(df: DataFrame, estimator, *more: str) -> DataFrame:
    """The columns ``more`` and those the estimator reads; all of them if it does not name its columns."""
    if not estimator.hasParam("featuresCol"):
        return df
    named = [estimator.getOrDefault(p) for p in ("labelCol", "featuresCol", "weightCol", "validationIndicatorCol")
             if estimator.hasParam(p) and estimator.isDefined(p)]
    return df.select(*dict.fromkeys(c for c in (*more, *named) if c))


def fits_at_once(df: DataFrame) -> int:
    """How many fits on ``df`` run side by side: small ones share the executors, large ones fill them."""
    least, most = FITS_AT_ONCE
    if FEATURES not in df.columns:
        return least
    row = df.select(FEATURES).first()
    cells = df.count() * max(1, row[0].size if row else 1)
    return max(least, min(most, CELLS_AT_ONCE // max(1, cells)))


def side_by_side(tasks: list[Callable], workers: int) -> list:
    """Results of independent driver calls, in their order."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(tasks), workers))) as ex:
        return list(ex.map(lambda task: task(), tasks))


def oof_and_full(df: DataFrame, estimator, fold: str, keys: Sequence[str], label: str = "label",
                 out: str = "predicted_score", parallelism: int | None = None, full: bool = True) -> tuple[DataFrame, object]:
    """What ``oof_predict`` gives and, with ``full``, the model fitted on all rows."""
    df = fit_columns(df, estimator, *keys, fold, label).persist()
    folds = _fold_values(df, fold)
    tasks = [lambda k=k: estimator.fit(df.where(F.col(fold) != k)) for k in folds] + [lambda: estimator.fit(df)] * full
    models = side_by_side(tasks, parallelism or fits_at_once(df))
    parts = [m.transform(df.where(F.col(fold) == k)).select(*keys, fold, label, F.col("prediction").alias(out))
             for k, m in zip(folds, models)]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res, models[-1] if full else None


def oof_predict(df: DataFrame, estimator, fold: str, keys: Sequence[str], label: str = "label",
                out: str = "predicted_score", parallelism: int | None = None) -> DataFrame:
    """Each row predicted by the model fitted on the other folds (M1).

    Output ``(keys…, fold, label, out)``. The columns that are read are persisted
    once; each fold fit is an independent distributed job, and up to ``parallelism``
    of them (default: by the table's size) are submitted at once so small fits share
    the executors instead of queueing behind each other's job latency.
    """
    return oof_and_full(df, estimator, fold, keys, label, out, parallelism, full=False)[0]


def fold_average_predict(train: DataFrame, unseen: DataFrame, estimator, fold: str,
                         keys: Sequence[str], out: str = "predicted_score") -> DataFrame:
    """Mean prediction of the k fold models on rows outside training.

    All models score a row in one pass over ``unseen``; rows of equal keys are averaged.
    """
    train = fit_columns(train, estimator, fold).persist()
    folds = _fold_values(train, fold)
    models = side_by_side([lambda k=k: estimator.fit(train.where(F.col(fold) != k)) for k in folds], fits_at_once(train))
    train.unpersist()
    u = unseen.select(*dict.fromkeys([*keys, FEATURES]))
    names = [f"_p_{i}" for i in range(len(models))]
    for name, m in zip(names, models):
        u = m.copy().setPredictionCol(name).transform(u)
    u = u.select(*keys, sum((F.col(n) for n in names[1:]), F.col(names[0])).alias("_sum"))
    return u.groupBy(*keys).agg((F.sum("_sum") / (F.count(F.lit(1)) * len(models))).alias(out))


# ------------------------------------------------------------------ search

@dataclass
class Space:
    """Ranges: ``int`` (lo, hi), ``float`` (lo, hi), ``log`` (lo, hi), ``cat`` [values]."""
    ints: dict = field(default_factory=dict)
    floats: dict = field(default_factory=dict)
    logs: dict = field(default_factory=dict)
    cats: dict = field(default_factory=dict)

    def sample(self, rng: random.Random) -> dict:
        import math
        p = {k: rng.randint(lo, hi) for k, (lo, hi) in self.ints.items()}
        p.update({k: rng.uniform(lo, hi) for k, (lo, hi) in self.floats.items()})
        p.update({k: math.exp(rng.uniform(math.log(lo), math.log(hi))) for k, (lo, hi) in self.logs.items()})
        p.update({k: rng.choice(v) for k, v in self.cats.items()})
        return p


def random_search(df: DataFrame, kind: str, space: Space, fold: str, n_trials: int = 5, seed: int = 42,
                  label: str = "label", parallelism: int | None = None, metric: str = "rmse", params: dict | None = None):
    """Seeded random search scored by CV over ``fold`` (M4). Returns (best params, table).

    A trial's score is the mean of its errors on the folds; nothing is fitted again on all rows.
    """
    rng = random.Random(seed)
    trials = [space.sample(rng) for _ in range(n_trials)]
    est = make_regressor(kind, params, seed, label)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    x = fit_columns(df, est, fold).persist()
    folds = _fold_values(x, fold)

    def error(t: dict, k) -> float:
        m = est.copy({est.getParam(name): v for name, v in t.items()}).fit(x.where(F.col(fold) != k))
        return ev.evaluate(m.transform(x.where(F.col(fold) == k)))

    errors = side_by_side([lambda t=t, k=k: error(t, k) for t in trials for k in folds], parallelism or fits_at_once(x))
    x.unpersist()
    scores = [sum(errors[i:i + len(folds)]) / len(folds) for i in range(0, len(errors), len(folds))]
    spark = df.sparkSession
    rows = [(i, str(t), float(s)) for i, (t, s) in enumerate(zip(trials, scores))]
    table = spark.createDataFrame(rows, "trial int, params string, score double")
    order = sorted(range(len(scores)), key=lambda i: scores[i], reverse=ev.isLargerBetter())
    best = order[0]
    return trials[best], table


# -------------------------------------------------------------- importance

def fold_importance(df: DataFrame, estimator, fold: str, slots: Sequence[str]) -> DataFrame:
    """``(feature, importance)``: mean over folds, on a 0–100 scale (M5)."""
    spark = df.sparkSession
    schema = dict(df.dtypes)
    df = fit_columns(df, estimator, fold).persist()
    folds = _fold_values(df, fold)
    models = side_by_side([lambda k=k: estimator.fit(df.where(F.col(fold) != k)) for k in folds], fits_at_once(df))
    df.unpersist()
    rows = [(k, s, float(v) * 100.0) for k, m in zip(folds, models) for s, v in zip(slots, m.featureImportances.toArray())]
    t = spark.createDataFrame(rows, f"fold {schema[fold]}, feature string, importance double")
    return t.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"))


def source_column(slot: str):
    """The column an input slot was made of."""
    return F.regexp_replace(F.col(slot), "__(imp|missing|idx)$", "")


def select_features(importance: DataFrame, threshold: float = 0.6) -> list[str]:
    """Distinct source column names with importance above ``threshold``."""
    return sorted({r[0] for r in importance.where(F.col("importance") > threshold)
                  .select(source_column("feature").alias("f")).distinct().collect()})


# ------------------------------------------------------ class probabilities

def class_labels(df: DataFrame, target: str, n_classes: int) -> DataFrame:
    """Target → ``n`` equal-frequency classes 0..n−1 in a double ``_class`` column."""
    return qcut(df, target, n_classes, out="_class").withColumn("_class", F.col("_class").cast("double"))


def make_classifier(seed: int = 42):
    return RandomForestClassifier(labelCol="_class", featuresCol=FEATURES, seed=seed, numTrees=30, maxDepth=6)


def probability_columns(model_output: DataFrame, keys: Sequence[str], n_classes: int) -> DataFrame:
    """``quantile_{i}_{n}`` columns from MLlib's probability vector."""
    arr = vector_to_array("probability")
    return model_output.select(*keys, *[arr[i].alias(f"quantile_{i}_{n_classes}") for i in range(n_classes)])


def class_probabilities(df: DataFrame, target: str, n_classes: int, fold: str, keys: Sequence[str],
                        seed: int = 42, unseen: DataFrame | None = None) -> DataFrame:
    """Target → ``n`` equal-frequency classes; OOF class probabilities (M6).

    Columns ``quantile_{i}_{n}``; rows of ``unseen`` are scored by the model
    fitted on all training rows.
    """
    clf = make_classifier(seed)
    x = fit_columns(class_labels(df, target, n_classes), clf, *keys, fold).persist()
    folds = _fold_values(x, fold)
    # fold fits are independent jobs
    tasks = [lambda k=k: clf.fit(x.where(F.col(fold) != k)) for k in folds] + [lambda: clf.fit(x)] * (unseen is not None)
    models = side_by_side(tasks, fits_at_once(x))
    parts = [probability_columns(m.transform(x.where(F.col(fold) == k)), keys, n_classes) for k, m in zip(folds, models)]
    if unseen is not None:
        parts.append(probability_columns(models[-1].transform(unseen), keys, n_classes))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------- saved models

def fit_pipeline(df: DataFrame, stages: list, estimator) -> PipelineModel:
    return Pipeline(stages=[*stages, estimator]).fit(df)


def save_model(model, path: str) -> None:
    """Save any fitted MLlib model; single models are wrapped in a ``PipelineModel``
    so ``load_model`` needs no class name."""
    pm = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    pm.write().overwrite().save(path)


def load_model(path: str, unwrap: bool = False):
    pm = PipelineModel.load(path)
    return pm.stages[0] if unwrap else pm


def predict(model: PipelineModel, df: DataFrame, keys: Sequence[str], out: str = "predicted_score") -> DataFrame:
    return model.transform(df).select(*keys, F.col("prediction").alias(out))
