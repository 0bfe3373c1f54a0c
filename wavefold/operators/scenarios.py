"""Counterfactual scenarios.

A scenario overrides one feature with one category (or shifts an income by
its median). The scenarios are a table, derived from the catalogue by Spark. A row
is repeated for each feature that any scenario changes (a short list of column
names) and meets that feature's scenarios in an equi-join: broadcast while the
scenario table is small, salted by the row beyond that, so that neither a feature
with many categories nor one with few lands in one task.

Scoring needs fewer rows. A scenario changes one feature, so only rows whose value
differs from the category can get another score (``override(..., changed=True)``);
``delta_means`` scores those and takes the rest from the baseline's sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .quantiles import exact_quantiles_many

# The reference's numeric survey features (excluded from the
# category catalogue) and the income features shifted by their median.
NUMERIC_FEATURES = ("rjob_hrswk", "rjob_end", "rearnings", "searnings", "hincome",
                    "hinc_business", "hinc_rent", "hinc_assets", "hinc_cap", "rinc_pension",
                    "sinc_pension", "a16a", "a21")
INCOME_FEATURES = ("hincome", "hinc_business", "hinc_rent", "hinc_assets", "hinc_cap",
                   "rinc_pension", "sinc_pension")

WAVES = ("_03", "_12")

#: Scenarios that are broadcast (a few hundred bytes each); more meet the rows in a salted join.
BROADCAST_SCENARIOS = 50_000
#: Salts of that join.
SALTS = 64

TABLE = "feature string, category string, y03 boolean, y12 boolean, feature_category string"


def catalogue(df: DataFrame, key: str = "uid") -> DataFrame:
    """Every observed value per base feature with wave flags and counts.

    Output ``(feature_name, category, year_03, year_12, count_03, count_12, count)``;
    ``count`` is only set for columns without a wave suffix. One pass: all
    columns are stacked to ``(column, value)`` and counted once.
    """
    cols = [c for c in df.columns if c != key]
    timed = [c for c in cols if c.endswith(WAVES)]
    bases = {c[:-3] for c in timed}
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("category")) for c in cols
    ])).alias("s")).select("s.col", "s.category").where(F.col("category").isNotNull())
    counts = stacked.groupBy("col", "category").agg(F.count(F.lit(1)).alias("n"))
    is_timed = F.col("col").endswith("_03") | F.col("col").endswith("_12")
    base = F.when(is_timed, F.expr("substring(col, 1, length(col) - 3)")).otherwise(F.col("col"))
    wave = F.when(is_timed, F.expr("substring(col, length(col) - 2, 3)"))
    c = counts.withColumn("feature_name", base).withColumn("wave", wave)
    has03 = F.create_map(*[x for b in sorted(bases) for x in (F.lit(b), F.lit(f"{b}_03" in cols))])
    has12 = F.create_map(*[x for b in sorted(bases) for x in (F.lit(b), F.lit(f"{b}_12" in cols))])
    g = c.groupBy("feature_name", "category").agg(
        F.max(F.col("wave").isNotNull()).alias("_timed"),
        F.sum(F.when(F.col("wave") == "_03", F.col("n")).otherwise(F.lit(0))).alias("count_03"),
        F.sum(F.when(F.col("wave") == "_12", F.col("n")).otherwise(F.lit(0))).alias("count_12"),
        F.sum(F.when(F.col("wave").isNull(), F.col("n"))).alias("count"),
    )
    if bases:
        y03 = F.coalesce(has03[F.col("feature_name")], F.lit(False))
        y12 = F.coalesce(has12[F.col("feature_name")], F.lit(False))
    else:
        y03 = y12 = F.lit(False)
    return g.select(
        "feature_name", "category",
        F.when(F.col("_timed"), y03).otherwise(F.lit(False)).alias("year_03"),
        F.when(F.col("_timed"), y12).otherwise(F.lit(False)).alias("year_12"),
        "count_03", "count_12", "count")


def filter_catalogue(cat: DataFrame, drop_features: Sequence[str] = (*NUMERIC_FEATURES, "age"),
                     min_count: int = 100) -> DataFrame:
    """Drop numeric features and age; keep ``max(count_03, count_12, count) > min_count``."""
    mx = F.greatest("count_03", "count_12", "count")
    return cat.withColumn("max_count", mx).where(
        ~F.col("feature_name").isin(list(drop_features)) & (F.col("max_count") > min_count))


def scenario_id(feature: str, category: str, suffix: str = "") -> str:
    """``feature@category`` with space . , / → ``_`` and parentheses removed."""
    s = f"{feature}@{category}{suffix}"
    return s.translate(str.maketrans({" ": "_", ".": "_", ",": "_", "/": "_", "(": None, ")": None}))


@dataclass
class Scenario:
    feature: str
    category: str
    year_03: bool
    year_12: bool

    def ident(self, only_12: bool = False) -> str:
        return scenario_id(self.feature, self.category, "_12" if only_12 else "")


def scenarios_from(cat: DataFrame) -> list[Scenario]:
    """The filtered catalogue as a scenario list: metadata, a row per column and frequent category."""
    rows = cat.orderBy("feature_name", "category").collect()
    return [Scenario(r["feature_name"], r["category"], bool(r["year_03"]), bool(r["year_12"])) for r in rows]


def split_valid(df: DataFrame, scenarios: Sequence[Scenario]) -> tuple[list[Scenario], DataFrame]:
    """Scenarios that ``df`` can take, and a table of the others with what is wrong with them.

    A category that does not cast to its column's type would turn values into
    nulls; a feature that ``df`` does not have would change nothing.
    """
    spark, types = df.sparkSession, dict(df.dtypes)
    targets = {s.feature: [f"{s.feature}{w}" for w in WAVES if f"{s.feature}{w}" in types] for s in scenarios}
    asked = [F.lit(s.category).try_cast(types[c]).isNotNull() for s in scenarios for c in targets[s.feature]]
    fits = iter(spark.range(1).select(F.array(*asked).alias("f")).first()["f"] if asked else [])
    good, bad = [], []
    for s in scenarios:
        casts = [next(fits) for _ in targets[s.feature]]
        if not casts:
            bad.append((s.ident(), s.feature, s.category, "no such feature"))
        elif not all(casts):
            bad.append((s.ident(), s.feature, s.category, f"not a {types[targets[s.feature][casts.index(False)]]}"))
        else:
            good.append(s)
    return good, spark.createDataFrame(bad, "feature_category string, feature string, category string, error string")


def scenario_table(cat: DataFrame, only_12: bool = False) -> DataFrame:
    """The scenarios of a filtered catalogue, as a table of ``TABLE``'s columns; nothing reaches the driver."""
    name = F.concat(F.col("feature_name"), F.lit("@"), F.col("category"), F.lit("_12" if only_12 else ""))
    return cat.select(
        F.col("feature_name").alias("feature"), "category",
        (F.col("year_03") & F.lit(not only_12)).alias("y03"), F.col("year_12").alias("y12"),
        F.translate(name, " .,/()", "____").alias("feature_category"))


def valid_table(df: DataFrame, table: DataFrame) -> DataFrame:
    """The scenarios ``df`` can take: the feature is there and the category is of its columns' types."""
    types, by_type = dict(df.dtypes), {}
    for c, t in types.items():
        if c.endswith(WAVES):
            by_type.setdefault(t, set()).add(c[:-3])
    fits = [F.when(F.col("feature").isin(sorted(names)), F.col("category").try_cast(t).isNotNull()) for t, names in sorted(by_type.items())]
    if not fits:
        return table.where(F.lit(False))
    known = F.col("feature").isin(sorted(set().union(*by_type.values())))
    return table.where(known & ~F.exists(F.array(*fits), lambda f: ~F.coalesce(f, F.lit(True))))


def _as_table(df: DataFrame, scenarios: Sequence[Scenario] | DataFrame, only_12: bool) -> DataFrame:
    if isinstance(scenarios, DataFrame):
        return scenarios
    return df.sparkSession.createDataFrame(
        [(s.feature, s.category, s.year_03 and not only_12, s.year_12, s.ident(only_12)) for s in scenarios], TABLE)


def _changes(df: DataFrame, feature: str) -> list[tuple[str, Column, Column]]:
    """(column, is overridden, value) of the feature's waves in rows that have met their scenario as ``_s``."""
    types, out = dict(df.dtypes), []
    for wave, flag in zip(WAVES, ("y03", "y12")):
        c = f"{feature}{wave}"
        if c in types:
            hit = (F.col("_s.feature") == feature) & F.col(f"_s.{flag}") & F.col(f"`{c}`").isNotNull()
            out.append((c, hit, F.col("_s.category").try_cast(types[c])))
    return out


def override(df: DataFrame, scenarios: Sequence[Scenario] | DataFrame, only_12: bool = False, changed: bool = False) -> DataFrame:
    """Row × scenario table: the scenario's feature is set to its category where not NULL.

    ``scenarios`` is a list or a table (``scenario_table``; ``only_12`` is then that
    table's). ``changed`` gives only rows whose values differ from the scenario's. No
    scenario gives no rows; a feature ``df`` does not have changes nothing.
    """
    table = _as_table(df, scenarios, only_12).select(*[c.split()[0] for c in TABLE.split(", ")])
    features = sorted(r[0] for r in table.select("feature").distinct().collect())  # names of columns
    if not features:
        return df.where(F.lit(False)).withColumn("feature_category", F.lit(None).cast("string"))
    rows = df.withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    met = table.select(F.col("feature").alias("_on"), F.struct("*").alias("_s"))
    if table.limit(BROADCAST_SCENARIOS + 1).count() <= BROADCAST_SCENARIOS:
        x = rows.join(F.broadcast(met), F.col("_feature") == F.col("_on"))
    else:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)))
        met = met.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        x = rows.join(met, (F.col("_feature") == F.col("_on")) & (F.col("_salt") == F.col("_at")))
    changes = [c for f in features for c in _changes(df, f)]
    if changed:
        differs = [hit & ~value.eqNullSafe(F.col(f"`{c}`")) for c, hit, value in changes]
        x = x.where(F.exists(F.array(F.lit(False), *[F.coalesce(d, F.lit(False)) for d in differs]), lambda d: d))
    exprs = {c: F.when(hit, value).otherwise(F.col(f"`{c}`")) for c, hit, value in changes}
    return x.withColumns(exprs).withColumn("feature_category", F.col("_s.feature_category")).select(*[F.col(f"`{c}`") for c in df.columns if c != "feature_category"], "feature_category")


def delta_means(rows: DataFrame, scenarios: Sequence[Scenario] | DataFrame, score: Callable[[DataFrame], DataFrame],
                by: str = "year", only_12: bool = False) -> DataFrame:
    """Mean score of every scenario and ``by``, scoring only rows that a scenario changes.

    ``score`` adds ``prediction`` to rows, row by row. A mean is the baseline's sum and
    what the changed rows add to it. Returns (feature_category, by, n, n_scored,
    mean_predicted); a null prediction counts in ``n`` and not in the mean.
    """
    table = _as_table(rows, scenarios, only_12)
    base = checkpoint(score(rows).select(*[F.col(f"`{c}`") for c in rows.columns], F.col("prediction").alias("_base")))
    known = lambda c: F.count(c).cast("long")
    totals = base.groupBy(by).agg(F.count(F.lit(1)).alias("n"), known("_base").alias("_k"), F.sum("_base").alias("_sum"))
    moved = score(override(base, table, changed=True)).groupBy("feature_category", by).agg(
        F.count(F.lit(1)).alias("n_scored"), (known("prediction") - known("_base")).alias("_dk"),
        F.sum(F.coalesce("prediction", F.lit(0.0)) - F.coalesce("_base", F.lit(0.0))).alias("_d"))
    # every scenario has a row for every value of ``by``, which are few: they come as one list beside it
    listed = totals.agg(F.collect_list(F.struct(by, "n", "_k", "_sum")).alias("_t")).first()["_t"]
    if not listed:
        return totals.select(F.lit("").alias("feature_category"), by, "n", F.col("n").alias("n_scored"), F.col("_sum").alias("mean_predicted"))
    each = F.explode(F.array(*[F.struct(*[F.lit(r[c]).cast(totals.schema[c].dataType).alias(c) for c in totals.columns]) for r in listed]))
    out = table.select("feature_category", each.alias("_t")).select("feature_category", "_t.*")
    out = out.alias("o").join(moved.alias("m"), (F.col("o.feature_category") == F.col("m.feature_category"))
                              & F.col(f"o.{by}").eqNullSafe(F.col(f"m.{by}")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("o.feature_category", f"o.{by}", "n", zero("n_scored").alias("n_scored"),
                      ((zero("_sum") + zero("_d")) / F.nullif(F.col("_k") + zero("_dk"), F.lit(0))).alias("mean_predicted"))


def median_shift(df: DataFrame, features: Sequence[str] = INCOME_FEATURES) -> DataFrame:
    """One scenario per feature: both waves shifted by their own median (C4)."""
    feats = [f for f in features if f"{f}_03" in df.columns and f"{f}_12" in df.columns]
    if not feats:
        return df.where(F.lit(False)).withColumn("feature_category", F.lit(None).cast("string"))
    meds = {c: v[0] for c, v in exact_quantiles_many(df, [f"{f}{w}" for f in feats for w in WAVES], [0.5]).items()}
    arr = F.array(*[F.lit(f) for f in feats])
    x = df.select("*", F.explode(arr).alias("_f"))
    exprs = {}
    for f in feats:
        for w in WAVES:
            c = f"{f}{w}"
            m = meds[c]
            shifted = F.col(c) + F.lit(m) if m is not None else F.lit(None).cast("double")
            exprs[c] = F.when(F.col("_f") == f, shifted).otherwise(F.col(c))
    return x.withColumns(exprs).withColumn(
        "feature_category", F.concat(F.col("_f"), F.lit("@add_median"))).drop("_f")
