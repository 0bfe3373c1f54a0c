"""Specification runs (M14, M15): the whole train → score flow as one Spark job graph.

``run_spec`` composes the operators in the reference's order — preprocessing
on train and test features together, participation codes, row matrices,
group statistics, the relative-change model, fold keys, class probabilities,
multi-seed base models, the L1 stack, per-category softmax blend and the
final seed average — and returns one long prediction table
``(spec, dataset, uid, year, model, seed, predicted_score)``.

A ``FeatureSpec`` switches feature families and perturbations on and off; a
list of specs is run with ``run_specs``. A ``SurveyConfig`` holds the column
vocabulary; ``SURVEY`` is the reference's, ``FIXTURE`` maps the driver's test
tables.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blend as bl
from ..operators import clean as cl
from ..operators import features as fe
from ..operators import folds as fo
from ..operators import groupstats as gs
from ..operators import models as mo
from ..operators import penalty as pn
from ..operators import participation as pa
from ..operators import reshape as rs
from ..operators import scenarios as sc
from ..operators.quantiles import exact_quantiles_many
from ..session import checkpoint
from . import survey
from .stages import Stage, Stages


@dataclass
class SurveyConfig:
    key: str = "uid"
    waves: dict = field(default_factory=lambda: {"_03": 2003, "_12": 2012})
    ordinal: dict = field(default_factory=dict)
    bands: dict = field(default_factory=dict)
    age_columns: tuple | None = None
    age_ranges: dict = field(default_factory=dict)
    onehot: Sequence[str] = ()
    income: Sequence[str] = ()
    group_vars: Sequence[str] = ()
    category: str = "narrowed_age_12"
    essential: Sequence[str] = ("uid",)


SURVEY = SurveyConfig(
    ordinal=survey.ORDINAL_COLUMNS, bands={**{c: survey.EDU_CATEGORIES for c in ("edu_gru_03", "edu_gru_12")},
                                           **{c: survey.LIVING_CHILDREN for c in ("n_living_child_03", "n_living_child_12")}},
    age_columns=("age_03", "age_12"), age_ranges=survey.AGE_RANGES, onehot=survey.CATEGORICAL_COLUMNS,
    income=survey.INCOME_COLUMNS, group_vars=survey.GROUP_VARS, essential=("uid", "age_03", "age_12"))


@dataclass
class FeatureSpec:
    name: str = "spec_full"
    group_stats: bool = True
    change: bool = True
    class_probs: bool = True
    drop_fraction: float | None = None
    winsorize: bool = False
    drop_sparse: bool = False
    models: Sequence[str] = ("gbt_deep", "gbt_shallow", "forest")
    n_seeds: int = 5
    n_trials: int = 5
    k: int = 5
    top_k: int = 6
    n_classes: int = 10
    importance: float = 0.6
    model_params: dict = field(default_factory=dict)


#: The vector column that boosted trees are fitted on and score.
VARYING = "varying"

# Search ranges of the model families and of the stack.
SPACES = {
    "gbt_deep": mo.Space(ints={"maxDepth": (4, 6)}, logs={"stepSize": (0.03, 0.3)}),
    "gbt_shallow": mo.Space(ints={"maxDepth": (2, 3)}, logs={"stepSize": (0.03, 0.3)}),
    "forest": mo.Space(ints={"maxDepth": (3, 8)}),
}
STACK_SPACE = mo.Space(logs={"regParam": (0.1, 0.5)}, floats={"quantile": (0.005, 0.5)})
# The grouping columns whose statistics of the change target the change model uses.
CHANGE_GROUPS = ("edu_gru_12", "narrowed_age_12", "year_participation")


def _numeric_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    num = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in df.dtypes if t in num and c not in set(exclude)]


def _waves_first_second(cols: Sequence[str]) -> tuple[list[str], list[str]]:
    return [c for c in cols if c.endswith("_03")], [c for c in cols if c.endswith("_12")]


@dataclass
class Prep:
    """Fitted preprocessing: caps, dropped columns and the one-hot vocabulary."""
    caps: cl.Caps | None
    dropped: list
    onehot: rs.OneHot


def fit_preprocess(raw: DataFrame, cfg: SurveyConfig, spec: FeatureSpec) -> Prep:
    """Fit on train and test features together, as the reference does."""
    x = raw
    if spec.drop_sparse:
        x = cl.drop_sparse_rows(x, *_waves_first_second(x.columns))
    caps = cl.fit_caps(x, [c for c in cfg.income if c in x.columns], 0.99) if spec.winsorize else None
    dropped = []
    if spec.drop_fraction:
        kept = cl.sample_columns(x, spec.drop_fraction, keep=cfg.essential, seed=42).columns
        dropped = [c for c in x.columns if c not in kept]
    x = x.drop(*dropped)
    if cfg.age_columns and all(c in x.columns for c in cfg.age_columns):
        x = cl.narrow_age(x, *cfg.age_columns, cfg.age_ranges)
    x = cl.recode_bands(cl.ordinal_encode(x, cfg.ordinal), cfg.bands)
    return Prep(caps, dropped, rs.fit_onehot(x, [c for c in cfg.onehot if c in x.columns], null_flag=True))


def apply_preprocess(raw: DataFrame, prep: Prep, cfg: SurveyConfig, spec: FeatureSpec) -> DataFrame:
    """Wide → encoded wide (reference order); the schema follows the fitted vocabulary."""
    x = raw
    if spec.drop_sparse:
        x = cl.drop_sparse_rows(x, *_waves_first_second(x.columns))
    if prep.caps is not None:
        x = prep.caps.apply(x)
    x = x.drop(*[c for c in prep.dropped if c in x.columns])
    if cfg.age_columns and all(c in x.columns for c in cfg.age_columns):
        x = cl.narrow_age(x, *cfg.age_columns, cfg.age_ranges)
    x = cl.recode_bands(cl.ordinal_encode(x, cfg.ordinal), cfg.bands)
    return fe.wave_differences(prep.onehot.apply(x), key=cfg.key)


def preprocess(raw: DataFrame, cfg: SurveyConfig, spec: FeatureSpec) -> DataFrame:
    return apply_preprocess(raw, fit_preprocess(raw, cfg, spec), cfg, spec)


def _fit_assembler(train: DataFrame, cols: Sequence[str]):
    tr = mo.prepare_inputs(train, cols)
    stages, _ = mo.assembler_stages(tr, cols)
    return Pipeline(stages=stages).fit(tr)


def _slots(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return mo.assembler_stages(mo.prepare_inputs(df, cols), cols)[1]


def _mark_varying(prep, df: DataFrame, cols: Sequence[str]):
    """``prep`` with one more vector column ``VARYING``: the slots that are not the same in every row of ``df``.

    Boosted trees look for a split on every slot at every node, and a slot without two values has none (the flag of a
    column that is never missing): their trees are the same without it. A forest draws slots and keeps the whole vector.
    """
    seen = _assemble_with(prep, df, cols).select(Summarizer.metrics("min", "max").summary(F.col(mo.FEATURES)).alias("s")).select("s.*").first()
    kept = [i for i, (a, b) in enumerate(zip(seen["min"], seen["max"])) if a != b]
    return PipelineModel([*prep.stages, VectorSlicer(inputCol=mo.FEATURES, outputCol=VARYING, indices=kept or [0])])


def _varying_slots(prep, slots: Sequence[str]) -> list[str]:
    return [slots[i] for i in prep.stages[-1].getIndices()]


def _assemble_with(prep, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    present = set(df.columns)
    x = df.withColumns({c: F.lit(None).cast("double") for c in cols if c not in present})
    return prep.transform(mo.prepare_inputs(x, cols))


def _with_prediction(df: DataFrame, asm, cols: Sequence[str], model, out: str) -> DataFrame:
    """``df`` with one more column, a model's prediction for every row."""
    v = model.copy().setPredictionCol(out).transform(_assemble_with(asm, df, cols))
    return v.select(*df.columns, out)


def _long(df: DataFrame, dataset: str, model: str, seed, col: str = "predicted_score") -> DataFrame:
    return df.select(F.lit(dataset).alias("dataset"), "uid", "year", F.lit(model).alias("model"),
                     F.lit(seed).cast("int").alias("seed"), F.col(col).cast("double").alias("predicted_score"))


def _finish(parts: list[DataFrame], key: str, spec: FeatureSpec) -> DataFrame:
    long = rs.union_all(parts)
    final = bl.finalize(long.where(F.col("model") == "blended"), ("dataset", key, "year"), "predicted_score",
                        out="predicted_score")
    final = final.select("dataset", key, "year", F.lit("final").alias("model"),
                         F.lit(None).cast("int").alias("seed"), "predicted_score")
    return long.unionByName(final).withColumn("spec", F.lit(spec.name))


@dataclass
class SpecModel:
    """Everything fitted on train that scoring new rows needs.

    Scoring reruns the row-wise preprocessing with the fitted vocabulary, caps,
    participation codes and group statistics, then the saved models, stack,
    category vocabulary and blend weights.
    """
    cfg: SurveyConfig
    spec: FeatureSpec
    prep: Prep
    patterns: DataFrame                 # (pattern, year_participation)
    stats: DataFrame | None             # long group statistics
    change: tuple | None                # (assembler, model, cols)
    classes: tuple | None               # (assembler, model, cols)
    base_prep: object
    base_cols: list
    base: dict                          # (kind, seed) → model
    stack: dict                         # seed → (model, fills)
    topk: fe.TopK
    category_source: str
    weights: dict                       # seed → (category, model, weight)
    fallback: dict                      # seed → (model, weight) from all train rows (Q8)
    years: list                         # label years
    change_stats: DataFrame | None      # long statistics of the change target

    @property
    def n_patterns(self) -> int:
        return self.patterns.count()

    def rows(self, features: DataFrame, keys: DataFrame) -> DataFrame:
        """One row per scoring key: raw features and the participation code.

        All joins by key happen here. Scenarios are expanded after it: an override
        changes no value from or to null, so keys, patterns and the sparse-row rule
        are the same for every scenario of a row.
        """
        cfg, key = self.cfg, self.cfg.key
        long_new = rs.wide_to_long(features, key, cfg.waves).select(key, "year")
        pats = pa.year_patterns(long_new, keys.select(key, "year"), key)
        codes = pa.PatternVocab(self.patterns).apply(pats, key)
        kept = features
        if self.spec.drop_sparse:
            kept = cl.drop_sparse_rows(kept, *_waves_first_second(kept.columns))
        return keys.select(key, "year").join(kept.join(codes, key, "left"), key, "left")

    def predicted(self, rows: DataFrame) -> DataFrame:
        """Every model's score as a column, row by row; columns ``_s_{model}_{seed}``.

        Only small fitted tables (group statistics, blend weights) are joined, so rows
        may be scenario rows: nothing here needs a row's key.
        """
        cfg, spec, key = self.cfg, self.spec, self.cfg.key
        ids = [c for c in (key, "year", "feature_category") if c in rows.columns]
        x = apply_preprocess(rows.withColumn("_year", F.col("year")), self.prep, cfg, replace(spec, drop_sparse=False))
        x = pa.participation_onehot(x, self.n_patterns)
        if self.classes is not None:
            x = self._class_columns(x)
        x = fe.age_interactions(fe.log_columns(x))
        if self.change is not None:
            asm, model, cols = self.change
            if self.change_stats is not None:
                x = gs.join_group_stats(x, self.change_stats, [g for g in CHANGE_GROUPS if g in x.columns], prefix="change_")
            x = _with_prediction(x, asm, cols, model, "composite_score_diff_pred")
        if self.stats is not None:
            x = gs.join_group_stats(x, self.stats, [g for g in cfg.group_vars if g in x.columns])
        category = F.col(self.category_source).cast("string")
        v = _assemble_with(self.base_prep, x, self.base_cols).withColumn("_category", self.topk.apply_to(category))
        for (kind, seed), model in self.base.items():
            out = f"_s_{kind}_{seed}"
            v = model.copy().setPredictionCol(out).transform(v).withColumn(out, bl.directed_round(out))
        v = v.drop(mo.FEATURES, VARYING)
        for seed, (lasso, fills) in self.stack.items():
            v = v.withColumns({f"composite_score_{kind}": F.col(f"_s_{kind}_{seed}") for kind in spec.models})
            out = f"_s_linear1_{seed}"
            v = lasso.copy().setPredictionCol(out).transform(_stack_inputs(v, fills)).drop(mo.FEATURES)
            v = v.withColumn(out, bl.directed_round(out))
            members = [*spec.models, "linear1"]
            w = self.weights[seed].groupBy("category").pivot("model", members).agg(F.first("weight")).withColumnsRenamed(
                {m: f"_w_{m}" for m in members}).withColumnRenamed("category", "_of")
            f = self.fallback[seed].groupBy().pivot("model", members).agg(F.first("weight")).first().asDict()  # one row
            v = v.join(w, v["_category"].eqNullSafe(w["_of"]), "left")
            v = v.withColumn(f"_s_blended_{seed}", sum(
                (F.coalesce(F.coalesce(F.col(f"_w_{m}"), F.lit(f[m])) * F.col(f"_s_{m}_{seed}"), F.lit(0.0)) for m in members),
                F.lit(0.0))).drop("_of", *[f"_w_{m}" for m in members])
        mean = sum((F.col(f"_s_blended_{s}") for s in self.stack), F.lit(0.0)) / F.lit(float(len(self.stack)))
        v = v.withColumn("year", F.col("_year")).withColumn("_s_final_", F.ceil(mean).cast("double"))
        return v.select(*ids, *[c for c in v.columns if c.startswith("_s_")])

    def _class_columns(self, x: DataFrame) -> DataFrame:
        """Class probabilities as if in each label year (``quantile_{i}_{n}_{year}``), and of the row's own year."""
        asm, model, cols = self.classes
        n, arr, before = self.spec.n_classes, vector_to_array("probability"), list(x.columns)
        for y in self.years:
            v = model.transform(_assemble_with(asm, x.withColumn("year", F.lit(y)), cols))
            x = v.select(*before, *[arr[i].alias(f"quantile_{i}_{n}_{y}") for i in range(n)])
            before = list(x.columns)
            x = x.withColumn("year", F.col("_year"))
        own = {}
        for i in range(n):
            c = F.lit(None).cast("double")
            for y in self.years:
                c = F.when(F.col("_year") == y, F.col(f"quantile_{i}_{n}_{y}")).otherwise(c)
            own[f"quantile_{i}_{n}"] = c
        return x.withColumns(own)

    def melted(self, predicted: DataFrame, *ids: str) -> DataFrame:
        """``(ids…, model, seed, predicted_score)`` of the score columns, once, at the end."""
        scores = F.array(*[F.struct(F.lit(m).alias("model"), (F.lit(int(s)) if s else F.lit(None)).cast("int").alias("seed"),
                                    F.col(c).cast("double").alias("predicted_score"))
                           for c in predicted.columns if c.startswith("_s_") for m, s in [c[3:].rsplit("_", 1)]])
        return predicted.select(*ids, F.inline(scores)).withColumn("spec", F.lit(self.spec.name))

    def score(self, features: DataFrame, keys: DataFrame, dataset: str = "test") -> DataFrame:
        """Long predictions for new rows: base models, stack, blend, final."""
        key = self.cfg.key
        out = self.predicted(self.rows(features, keys)).withColumn("dataset", F.lit(dataset))
        return self.melted(out, "dataset", key, "year")

    # ------------------------------------------------------------ persistence
    def save(self, path: str) -> None:
        from ..sources import io
        spark = self.patterns.sparkSession
        root = path.rstrip("/")
        tables = {"patterns": self.patterns}
        if self.stats is not None:
            tables["stats"] = self.stats
        if self.change_stats is not None:
            tables["change_stats"] = self.change_stats
        for seed, w in self.weights.items():
            tables[f"weights_{seed}"] = w
            tables[f"fallback_{seed}"] = self.fallback[seed]
        params = {
            "spec": {k: v for k, v in self.spec.__dict__.items()},
            "cfg": {k: (list(v) if isinstance(v, tuple) else v) for k, v in self.cfg.__dict__.items()},
            "prep": _prep_values(self.prep),
            "base_cols": self.base_cols, "base": [[k, s] for k, s in self.base],
            "stack": {str(s): [[c, v] for c, v in f.items()] for s, (_, f) in self.stack.items()},
            "topk": {"col": self.topk.col, "values": self.topk.values, "other": self.topk.other},
            "category_source": self.category_source, "years": self.years, "change_stats": self.change_stats is not None,
            "change_cols": self.change[2] if self.change else None,
            "class_cols": self.classes[2] if self.classes else None,
        }
        io.write_bundle(tables, params, root, spark)
        mo.save_model(self.base_prep, f"{root}/models/base_prep")
        for (kind, seed), m in self.base.items():
            mo.save_model(m, f"{root}/models/base_{kind}_{seed}")
        for seed, (m, _) in self.stack.items():
            mo.save_model(m, f"{root}/models/stack_{seed}")
        for name, part in (("change", self.change), ("classes", self.classes)):
            if part is not None:
                mo.save_model(part[0], f"{root}/models/{name}_prep")
                mo.save_model(part[1], f"{root}/models/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SpecModel":
        from ..sources import io
        root = path.rstrip("/")
        _, p = io.read_bundle(spark, root, [])
        spec = FeatureSpec(**p["spec"])
        cfg_d = dict(p["cfg"])
        if cfg_d.get("age_columns") is not None:
            cfg_d["age_columns"] = tuple(cfg_d["age_columns"])
        cfg_d["age_ranges"] = {k: tuple(v) for k, v in cfg_d.get("age_ranges", {}).items()}
        cfg = SurveyConfig(**cfg_d)
        names = ["patterns"] + (["stats"] if spec.group_stats else []) + \
            (["change_stats"] if p["change_stats"] else []) + \
            [f"weights_{s}" for s in range(spec.n_seeds)] + [f"fallback_{s}" for s in range(spec.n_seeds)]
        tables, _ = io.read_bundle(spark, root, names)
        prep = _prep_of(p["prep"])
        load = lambda n: mo.load_model(f"{root}/models/{n}", unwrap=True)
        part = lambda n, cols: (mo.load_model(f"{root}/models/{n}_prep"), load(n), cols) if cols else None
        return cls(
            cfg=cfg, spec=spec, prep=prep, patterns=tables["patterns"], stats=tables.get("stats"),
            change=part("change", p["change_cols"]), classes=part("classes", p["class_cols"]),
            base_prep=mo.load_model(f"{root}/models/base_prep"), base_cols=p["base_cols"],
            base={(k, s): load(f"base_{k}_{s}") for k, s in p["base"]},
            stack={int(s): (load(f"stack_{s}"), dict(f)) for s, f in p["stack"].items()},
            topk=fe.TopK(**p["topk"]), category_source=p["category_source"],
            weights={s: tables[f"weights_{s}"] for s in range(spec.n_seeds)},
            fallback={s: tables[f"fallback_{s}"] for s in range(spec.n_seeds)},
            years=p["years"], change_stats=tables.get("change_stats"))


def _stack_inputs(df: DataFrame, fills: dict) -> DataFrame:
    """The stack's vector: features and base predictions in the order of ``fills``, nulls filled with them."""
    filled = {f"_f_{i}": F.coalesce(F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double"),
                                    F.lit(0.0 if v is None else float(v))) for i, (c, v) in enumerate(fills.items())}
    va = VectorAssembler(inputCols=list(filled), outputCol=mo.FEATURES, handleInvalid="keep")
    return va.transform(df.withColumns(filled)).drop(*filled)


def fit_stack(wide: DataFrame, columns: Sequence[str], fold: str, n_trials: int, seed: int = 1):
    """L1 stack over features and base predictions (M9): penalty and filling quantile are searched by
    the error over grouped folds, all trials from one scan. Returns (model, fill values)."""
    rng = random.Random(seed)
    trials = [STACK_SPACE.sample(rng) for _ in range(max(1, n_trials))]
    fills = exact_quantiles_many(wide, columns, [t["quantile"] for t in trials])
    best = 0
    if n_trials > 1:
        found = pn.moments(wide, columns, fold, centers=[fills[c][0] for c in columns])
        errors = pn.search(found, [(t["regParam"], [fills[c][i] for c in columns]) for i, t in enumerate(trials)])
        best = min(range(len(trials)), key=lambda i: (errors[i], i))
    here = {c: fills[c][best] for c in columns}
    est = mo.make_regressor("lasso", {"regParam": trials[best]["regParam"]}, 5)
    return est.fit(_stack_inputs(wide, here).select("label", mo.FEATURES)), here


def _prep_values(prep: Prep) -> dict:
    return {"caps": prep.caps.values if prep.caps else None, "dropped": prep.dropped,
            "onehot": prep.onehot.values, "null_flag": prep.onehot.null_flag}


def _prep_of(values: dict) -> Prep:
    return Prep(cl.Caps(values["caps"]) if values["caps"] else None, values["dropped"],
                rs.OneHot(values["onehot"], values["null_flag"]))


def fit_spec(spark: SparkSession, train_features: DataFrame, train_labels: DataFrame,
             cfg: SurveyConfig, spec: FeatureSpec, vocab_features: DataFrame | None = None,
             vocab_keys: DataFrame | None = None, stages: Stages | None = None) -> tuple[DataFrame, SpecModel]:
    """Fit every stage on train; return train predictions (out of fold) and the model.

    ``vocab_features`` / ``vocab_keys`` (e.g. the test features) join the train
    rows where the reference fits on train and test together: the one-hot
    vocabulary, the caps and the column sample.

    Each stage names the flags it depends on and is run by ``stages``, which shares it with other
    specifications of the same flags and, with a folder, takes it up from an earlier run.
    """
    stages = stages or Stages(spark)
    key = cfg.key
    on_prep = {"cfg": cfg.__dict__, "drop_fraction": spec.drop_fraction, "winsorize": spec.winsorize, "drop_sparse": spec.drop_sparse}
    on_classes = {**on_prep, "class_probs": spec.class_probs} | ({
        "k": spec.k, "n_classes": spec.n_classes, "importance": spec.importance, "params": spec.model_params} if spec.class_probs else {})
    on_change = {**on_classes, "change": spec.change, "group_stats": spec.group_stats, "k": spec.k,
                 "params": spec.model_params if spec.change else None}
    on_base = {**on_change, "trials": spec.n_trials, "seeds": spec.n_seeds, "params": spec.model_params}
    on_stack = {**on_base, "models": list(spec.models), "top_k": spec.top_k}

    def encode() -> Stage:
        raw = rs.union_all([train_features] + ([vocab_features] if vocab_features is not None else []))
        fitted = fit_preprocess(raw, cfg, spec)
        x = apply_preprocess(train_features, fitted, cfg, spec)
        long_tr = rs.wide_to_long(train_features, key, cfg.waves).select(key, "year")
        pats_tr = pa.year_patterns(long_tr, train_labels.select(key, "year"), key)
        table = checkpoint(pa.fit_pattern_vocab(pats_tr).table)
        x = x.join(pa.PatternVocab(table).apply(pats_tr, key), key, "left")
        # the code is kept next to its one-hot columns, as in the reference (K3)
        return Stage({"enc": checkpoint(pa.participation_onehot(x, table.count())), "patterns": table}, _prep_values(fitted))

    encoded = stages.run("encode", on_prep, encode)
    prep_fit, enc, patterns = _prep_of(encoded.values), encoded.tables["enc"], encoded.tables["patterns"]
    rows = train_labels.select(key, "year", "composite_score").join(enc, key, "left")
    years = sorted(r[0] for r in train_labels.select("year").distinct().collect())  # label years

    def class_stage() -> Stage:
        raw_cols = _numeric_columns(enc, [key])
        asm = _mark_varying(_fit_assembler(rows, raw_cols), rows, raw_cols)
        slots = _varying_slots(asm, _slots(rows, raw_cols))
        folded = checkpoint(fo.kfold(_assemble_with(asm, rows, raw_cols).withColumn("label", F.col("composite_score")),
                                     [key, "year"], spec.k, 42, out="rfold").select("rfold", "label", F.col(VARYING).alias(mo.FEATURES)))
        importance = mo.fold_importance(folded, mo.make_regressor("gbt_shallow", spec.model_params, 42), "rfold", slots)
        chosen = set(mo.select_features(importance, spec.importance))
        cols0 = [c for c in raw_cols if c in chosen] or raw_cols
        cols0 = [*cols0, "year"]
        asm0 = _fit_assembler(rows, cols0)
        tr_v = checkpoint(fo.kfold(_assemble_with(asm0, rows, cols0), [key, "year"], spec.k, 42, out="rfold").select(
            key, "year", "composite_score", "rfold", mo.FEATURES))
        probs = checkpoint(mo.class_probabilities(tr_v, "composite_score", spec.n_classes, "rfold", [key, "year"], 42))
        clf = mo.make_classifier(42).fit(mo.class_labels(tr_v, "composite_score", spec.n_classes))
        return Stage({"probs": probs}, {"cols": cols0}, {"classifier": clf}, {"assembler": asm0})

    # class probabilities come first, on selected features and the year; later stages use them
    classes = probs = None
    if spec.class_probs:
        got = stages.run("classes", on_classes, class_stage)
        probs, classes = got.tables["probs"], (got.pipelines["assembler"], got.models["classifier"], got.values["cols"])

    train = fe.age_interactions(fe.log_columns(rows))

    stats = None
    gv = [g for g in cfg.group_vars if g in train.columns]
    if spec.group_stats and gv:
        plain = train
        stats = stages.run("group_stats", on_prep, lambda: Stage({"stats": checkpoint(
            gs.group_stats_multi(plain, gv, "composite_score", [key, "year"]))})).tables["stats"]
        train = gs.join_group_stats(train, stats, gv)

    pairs = cl.complete_pairs(train_labels, key)

    def change_stage() -> Stage:
        tables = {}
        target = rs.pivot_change(train_labels, key).select(key, F.col("composite_score_diff").alias("label"))
        wide = fe.age_interactions(fe.log_columns(enc))
        if probs is not None:
            names = [c for c in probs.columns if c.startswith("quantile_")]
            wide = wide.join(rs.pivot_block(probs, key, "year", years, names), key, "left")
        labelled = cl.semi_join(wide, pairs, key).join(target, key).where(F.col("label").isNotNull())
        groups = [g for g in CHANGE_GROUPS if g in wide.columns]
        if groups and spec.group_stats:
            tables["change_stats"] = checkpoint(gs.group_stats_multi(labelled, groups, "label", [key]))
            wide = gs.join_group_stats(wide, tables["change_stats"], groups, prefix="change_")
            labelled = gs.join_group_stats(labelled, tables["change_stats"], groups, prefix="change_")
        wide_cols = _numeric_columns(wide, [key])
        wtrain = fo.kfold(labelled, key, spec.k, 42, out="fold1")
        asm = _mark_varying(_fit_assembler(wtrain, wide_cols), wtrain, wide_cols)
        wtrain_v = checkpoint(_assemble_with(asm, wtrain, wide_cols).select(key, "fold1", "label", F.col(VARYING).alias(mo.FEATURES)))
        est = mo.make_regressor("gbt_shallow", spec.model_params, 42)
        oof, full_model = mo.oof_and_full(wtrain_v, est, "fold1", [key], out="composite_score_diff_pred")
        full_model.setFeaturesCol(VARYING)
        rest = _assemble_with(asm, cl.anti_join(wide, wtrain.select(key), key), wide_cols)
        full = full_model.transform(rest).select(key, F.col("prediction").alias("composite_score_diff_pred"))
        tables["diff"] = checkpoint(oof.select(key, "composite_score_diff_pred").unionByName(full))
        return Stage(tables, {"cols": wide_cols}, {"regressor": full_model}, {"assembler": asm})

    change = change_stats = None
    if spec.change:
        got = stages.run("change", on_change, change_stage)
        train = train.join(got.tables["diff"], key, "left")
        change, change_stats = (got.pipelines["assembler"], got.models["regressor"], got.values["cols"]), got.tables.get("change_stats")

    def matrix() -> Stage:
        fold1 = fo.kfold(pairs, key, spec.k, 42, out="fold1")
        x = checkpoint(fo.combined_fold(train, fold1, key, spec.k, 42, row_keys=(key, "year")))
        x = fo.group_kfold(x, "combined_fold", spec.k, out="gfold")
        if probs is not None:
            x = x.join(probs, [key, "year"], "left")
        x = checkpoint(x)
        names = _numeric_columns(x, [key, "composite_score", "fold1", "gfold", "label"])
        return Stage({"train": x}, {"cols": names}, pipelines={"assembler": _mark_varying(_fit_assembler(x, names), x, names)})

    got = stages.run("matrix", on_change, matrix)
    train, cols, base_prep = got.tables["train"], got.values["cols"], got.pipelines["assembler"]
    vectors: list[DataFrame] = []

    def train_v(vector: str) -> DataFrame:
        if not vectors:
            vectors.append(checkpoint(_assemble_with(base_prep, train.withColumn("label", F.col("composite_score")), cols).select(
                key, "year", "gfold", "label", mo.FEATURES)))
        if vector == mo.FEATURES:
            return vectors[0]
        return base_prep.stages[-1].transform(vectors[0]).drop(mo.FEATURES).withColumnRenamed(vector, mo.FEATURES)

    def base(kind: str) -> Stage:
        out = Stage()
        params = dict(spec.model_params)
        vector = VARYING if mo.FAMILIES[kind][0] is mo.GBTRegressor else mo.FEATURES
        if spec.n_trials > 1:  # each family is searched once, its seeds share the result
            params |= mo.random_search(train_v(vector), kind, SPACES[kind], "gfold", spec.n_trials, 1, params=params)[0]
        for seed in range(spec.n_seeds):
            est = mo.make_regressor(kind, params, seed)
            oof, full = mo.oof_and_full(train_v(vector), est, "gfold", [key, "year"])
            out.models[f"model_{seed}"] = full.setFeaturesCol(vector)
            out.tables[f"oof_{seed}"] = checkpoint(oof.withColumn("predicted_score", bl.directed_round("predicted_score")))
        return out

    parts, base_tr, base_models = [], {}, {}
    for kind in spec.models:
        got = stages.run(f"base_{kind}", on_base, lambda: base(kind))
        for seed in range(spec.n_seeds):
            base_tr[(kind, seed)], base_models[(kind, seed)] = got.tables[f"oof_{seed}"], got.models[f"model_{seed}"]
            parts.append(_long(base_tr[(kind, seed)], "train", kind, seed))

    cat_src = cfg.category if cfg.category in train.columns else "year"
    cats_tr = train.select(key, "year", F.col(cat_src).cast("string").alias("category"))
    truth = train.select(key, "year", "composite_score")

    def blend_stage(seed: int) -> Stage:
        # L1 stack over the features and this seed's base predictions; in-sample on train (Q5)
        w = train.select(key, F.col("year").cast("int").alias("year"), F.col("composite_score").alias("label"), "gfold",
                             *[F.col(c).cast("double").alias(c) for c in cols if c != "year"])
        for kind in spec.models:
            b = base_tr[(kind, seed)].select(key, F.col("year").cast("int").alias("year"),
                                             F.col("predicted_score").alias(f"composite_score_{kind}"))
            w = w.join(b, [key, "year"])
        w = checkpoint(w)
        names = [*[c for c in cols if c != "year"], "year", *[f"composite_score_{kind}" for kind in spec.models]]
        lasso, fills = fit_stack(w, names, "gfold", spec.n_trials)
        lin_tr = checkpoint(lasso.transform(_stack_inputs(w, fills)).select(
            key, "year", bl.directed_round("prediction").alias("predicted_score")))
        # per-category softmax blend of base models and the stack
        top = fe.fit_top_k(cats_tr, "category", spec.top_k)
        ptr = rs.union_all([_long(base_tr[(k, seed)], "train", k, seed) for k in spec.models]
                           + [_long(lin_tr, "train", "linear1", seed)])
        ptr = ptr.join(top.apply(cats_tr, out="category"), [key, "year"]).join(truth, [key, "year"])
        weights = checkpoint(bl.group_rmse_weights(ptr))
        # a category without train rows is blended with weights from all train rows (Q8)
        fallback = checkpoint(bl.group_rmse_weights(ptr.withColumn("category", F.lit("all"))).select("model", "weight"))
        blended = checkpoint(bl.blend(ptr, weights, fallback=fallback).withColumn("seed", F.lit(seed)))
        return Stage({"linear": lin_tr, "weights": weights, "fallback": fallback, "blended": blended},
                     {"fills": [[c, v] for c, v in fills.items()], "top": {"col": top.col, "values": top.values, "other": top.other}},
                     {"lasso": lasso})

    stack, weights, fallback, topk = {}, {}, {}, None
    for seed in range(spec.n_seeds):
        got = stages.run(f"stack_{seed}", on_stack, lambda: blend_stage(seed))
        stack[seed] = (got.models["lasso"], {c: v for c, v in got.values["fills"]})
        weights[seed], fallback[seed], topk = got.tables["weights"], got.tables["fallback"], fe.TopK(**got.values["top"])
        parts.append(_long(got.tables["linear"], "train", "linear1", seed))
        parts.append(_long(got.tables["blended"], "train", "blended", seed, "blended_score"))

    model = SpecModel(cfg=cfg, spec=spec, prep=prep_fit, patterns=patterns, stats=stats, change=change,
                      classes=classes, base_prep=base_prep, base_cols=cols, base=base_models, stack=stack,
                      topk=topk, category_source=cat_src, weights=weights, fallback=fallback, years=years,
                      change_stats=change_stats)
    return _finish(parts, key, spec), model


def run_spec(spark: SparkSession, train_features: DataFrame, train_labels: DataFrame,
             test_features: DataFrame, test_keys: DataFrame, cfg: SurveyConfig,
             spec: FeatureSpec, stages: Stages | None = None) -> DataFrame:
    """Train (out-of-fold) and test predictions of one specification, long."""
    train_pred, model = fit_spec(spark, train_features, train_labels, cfg, spec,
                                 vocab_features=test_features, stages=stages)
    return train_pred.unionByName(model.score(test_features, test_keys))


def run_specs(spark: SparkSession, specs: Sequence[FeatureSpec], train_features: DataFrame, train_labels: DataFrame,
              test_features: DataFrame, test_keys: DataFrame, cfg: SurveyConfig, stages: Stages | None = None) -> DataFrame:
    """Several specifications into one long table with the column ``spec``.

    All run on one graph of stages: what two specifications have in common is fitted once. With a
    ``Stages`` that has a folder, finished stages are taken up from earlier runs (S7).
    """
    stages = stages or Stages(spark)
    return rs.union_all([run_spec(spark, train_features, train_labels, test_features, test_keys, cfg, s, stages) for s in specs])


PERTURBED = FeatureSpec(name="spec_perturbed", change=False, class_probs=False,
                        drop_fraction=0.5, winsorize=True, drop_sparse=True)


def specification_list() -> list[FeatureSpec]:
    """The specifications of the reference's specification script, in its order."""
    full = FeatureSpec(name="spec_full")
    return [replace(full, name="spec_1", group_stats=False, change=False, class_probs=False),
            replace(full, name="spec_2", change=False, class_probs=False),
            replace(full, name="spec_3", class_probs=False),
            replace(full, name="drop_random_features", drop_fraction=0.5),
            replace(full, name="replace_outliers", winsorize=True),
            replace(full, name="remove_na_obs", drop_sparse=True),
            full]


def score_scenarios(model: SpecModel, features: DataFrame, scenarios: Sequence[sc.Scenario], keys: DataFrame) -> DataFrame:
    """Score every scenario of every row with one fitted bundle in one pass.

    Keys, patterns and features are joined on the rows as they are; the expansion
    comes after it, and what follows works row by row. Scenarios whose category is
    none of the feature's type belong into the table of `scenarios.split_valid`.
    """
    rows = sc.override(model.rows(features, keys), scenarios)
    return model.melted(model.predicted(rows), "feature_category", model.cfg.key, "year")
