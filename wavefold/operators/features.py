"""Feature operators.

Bin edges, vocabularies and caps are fitted once on train and returned as
small objects whose ``apply`` is a pure projection, so the same plan scores
test rows and scenario rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import positive_log
from .quantiles import exact_quantiles, exact_quantiles_many

# The income columns the reference log-transforms, in its order.
LOG_COLUMNS = (
    "hincome_03", "hincome_12", "hinc_business_03", "hinc_business_12",
    "hinc_rent_03", "hinc_rent_12", "hinc_assets_03", "hinc_assets_12",
    "hinc_cap_03", "hinc_cap_12", "rinc_pension_03", "rinc_pension_12",
    "sinc_pension_03", "sinc_pension_12",
    "hincome_diff", "hinc_business_diff", "hinc_rent_diff", "hinc_assets_diff",
)


def log_columns(df: DataFrame, cols: Sequence[str] = LOG_COLUMNS) -> DataFrame:
    """``ln x`` where ``x > 0`` else NULL, for the columns that exist."""
    exprs = {c: positive_log(c) for c in cols if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def age_interactions(df: DataFrame, age: str = "narrowed_age_12", income: str = "hincome_12") -> DataFrame:
    """``age_squared`` and ``age_income_interaction`` when the inputs exist."""
    if age not in df.columns:
        return df
    out = df.withColumn("age_squared", F.col(age) * F.col(age))
    if income in df.columns:
        out = out.withColumn("age_income_interaction", F.col(age) * F.col(income))
    return out


def wave_differences(df: DataFrame, first: str = "_03", second: str = "_12",
                     exclude: Sequence[str] = ("narrowed_age_03", "narrowed_age_12"),
                     key: str = "uid") -> DataFrame:
    """``{base}_diff = {base}{first} − {base}{second}`` for every numeric pair."""
    types = dict(df.dtypes)
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    exprs = {}
    for c in df.columns:
        if c == key or c in exclude or not c.endswith(second):
            continue
        base = c[: -len(second)]
        a = base + first
        if a in df.columns and a not in exclude and types[a] in numeric and types[c] in numeric:
            exprs[f"{base}_diff"] = F.col(a) - F.col(c)
    return df.withColumns(exprs) if exprs else df


# -------------------------------------------------------------------- binning

def right_closed_bin(x: Column, edges: Sequence[float]) -> Column:
    """``pd.cut(..., labels=False, include_lowest=True)``: code 0..len(edges)−2.

    Bins are ``[e0, e1], (e1, e2], …``; values outside ``[e0, e_last]`` → NULL.
    """
    expr = F.when(x.isNull() | (x < edges[0]) | (x > edges[-1]), F.lit(None).cast("int"))
    for i in range(1, len(edges)):
        expr = expr.when(x <= edges[i], F.lit(i - 1))
    return expr


@dataclass
class Bins:
    edges: dict[str, list[float]]
    suffix: str = "_q"

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c + self.suffix: right_closed_bin(F.col(c), e)
                               for c, e in self.edges.items() if c in df.columns})


def fit_bins(df: DataFrame, cols: Sequence[str], bins: int = 4, suffix: str = "_q") -> Bins:
    """Quantile edges from train, each value once (X16); a column without two different edges has no bins and raises."""
    found = exact_quantiles_many(df, cols, [i / bins for i in range(bins + 1)])
    edges = {c: sorted({float(v) for v in found[c] if v is not None}) for c in cols}
    flat = [c for c, e in edges.items() if len(e) < 2]
    if flat:
        raise ValueError(f"no bins for columns of one value or none: {', '.join(flat)}")
    return Bins(edges, suffix)


def qcut(df: DataFrame, col: str, n: int, out: str | None = None, labels: bool = False,
         duplicates: str = "raise") -> DataFrame:
    """Equal-frequency codes like ``pd.qcut(x, n)``.

    ``labels=True`` gives ``q1..qn`` strings; duplicate edges raise unless
    ``duplicates='drop'``, which merges them.
    """
    out = out or f"{col}_qcut"
    probs = list(np.linspace(0, 1, n + 1))
    raw = np.array(exact_quantiles(df, col, probs), dtype=float)
    e = np.unique(raw)
    if len(e) != len(raw) and duplicates == "raise":
        raise ValueError(f"Bin edges must be unique: {raw.tolist()}")
    code = right_closed_bin(F.col(col), [float(v) for v in e])
    if labels:
        code = F.concat(F.lit("q"), (code + 1).cast("string"))
    return df.withColumn(out, code)


# ----------------------------------------------------------------- top-k vocab

@dataclass
class TopK:
    col: str
    values: list
    other: str = "other"

    def apply(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """Keep the fitted categories, everything else → ``other``."""
        return df.withColumn(out or self.col, self.apply_to(F.col(self.col).cast("string")))

    def apply_to(self, c: Column) -> Column:
        return F.when(c.isin([str(v) for v in self.values]), c).otherwise(F.lit(self.other))


def fit_top_k(df: DataFrame, col: str, k: int = 6, other: str = "other") -> TopK:
    """The ``k`` most frequent values (ties by value); at most ``k`` rows reach the driver."""
    top = (df.groupBy(F.col(col).cast("string").alias("v")).count()
           .where(F.col("v").isNotNull())
           .orderBy(F.desc("count"), F.asc("v")).limit(k).collect())
    return TopK(col, [r["v"] for r in top], other)


def value_counts_long(df: DataFrame, cols: Sequence[str], null_label: str = "nan") -> DataFrame:
    """``(Feature, Categories, N)`` for many columns in one job; NULL → ``nan`` (A3)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("Feature"),
                 F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias("Categories"))
        for c in cols])).alias("s")).select("s.Feature", "s.Categories")
    return stacked.groupBy("Feature", "Categories").agg(F.count(F.lit(1)).alias("N"))
