"""Reshape operators.

Pivots always receive their explicit values (no extra distinct job, fixed
schema); long → wide happens as late as possible because wide rows of 300+
columns leave whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import sanitize_name


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, filling columns missing on one side with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wide_to_long(df: DataFrame, key: str = "uid",
                 waves: Mapping[str, int] | None = None) -> DataFrame:
    """One row per key and observed wave.

    Columns ending with a wave suffix are renamed to their base name and tagged
    with the wave's ``year``; a row whose wave columns are all NULL is dropped;
    a base column missing from a wave is NULL there. One scan: every row emits
    one struct per wave through a generator (no union of per-wave scans).
    """
    waves = waves or {"_03": 2003, "_12": 2012}
    types = dict(df.dtypes)
    bases: dict[str, dict[str, str]] = {}
    for suffix in waves:
        for c in df.columns:
            if c != key and c.endswith(suffix):
                bases.setdefault(c[: -len(suffix)], {})[suffix] = c
    if not bases:
        raise ValueError("no wave columns")

    def common_type(cols):
        ts = {types[c] for c in cols}
        if len(ts) == 1:
            return ts.pop()
        return "double" if ts <= set(_NUMERIC) else "string"

    btype = {b: common_type(m.values()) for b, m in bases.items()}
    present = [s for s in waves if any(s in m for m in bases.values())]
    structs = []
    for suffix in present:
        cols = [F.col(m[suffix]).cast(btype[b]).alias(b) if suffix in m else F.lit(None).cast(btype[b]).alias(b)
                for b, m in bases.items()]
        observed = reduce(lambda a, b: a | b,
                          [F.col(m[suffix]).isNotNull() for m in bases.values() if suffix in m])
        structs.append(F.struct(F.lit(waves[suffix]).alias("year"), observed.alias("_any"), *cols))
    long = df.select(key, F.explode(F.array(*structs)).alias("_w")).where(F.col("_w._any"))
    return long.select(key, *[F.col(f"_w.{b}").alias(b) for b in bases], F.col("_w.year").alias("year"))


def pivot_change(df: DataFrame, key: str = "uid", period: str = "year",
                 value: str = "composite_score", first: int = 2016, second: int = 2021,
                 out: str | None = None) -> DataFrame:
    """One row per key with both periods and the relative change (R2).

    ``(v_first − v_second) / v_second``; a zero or missing second value gives
    NULL. A key with two rows for one period raises (pandas ``pivot`` does).
    """
    out = out or f"{value}_diff"
    v = F.col(value)
    agg = df.where(F.col(period).isin(first, second)).groupBy(key).agg(
        F.first(F.when(F.col(period) == first, v), ignorenulls=True).alias(f"{value}_{first}"),
        F.first(F.when(F.col(period) == second, v), ignorenulls=True).alias(f"{value}_{second}"),
        F.sum(F.when(F.col(period) == first, 1).otherwise(0)).alias("_n1"),
        F.sum(F.when(F.col(period) == second, 1).otherwise(0)).alias("_n2"),
    )
    dup = (F.col("_n1") > 1) | (F.col("_n2") > 1)
    a, b = F.col(f"{value}_{first}"), F.col(f"{value}_{second}")
    change = F.when(dup, F.raise_error(F.lit("duplicate (key, period) rows in pivot"))) \
        .otherwise(F.try_divide(a - b, F.when(b != 0, b)))
    return agg.select(key, a, b, change.cast("double").alias(out))


def pivot_block(df: DataFrame, key: str, period: str, periods: Sequence, values: Sequence[str]) -> DataFrame:
    """Pivot several value columns by period, names ``{value}_{period}``.

    A second row for a key and period raises (pandas ``pivot`` does).
    """
    one = lambda c: F.when(F.count(F.lit(1)) <= 1, F.first(c, ignorenulls=True)).otherwise(
        F.raise_error(F.lit("duplicate (key, period) rows in pivot")))
    once = df.where(F.col(period).isin(list(periods))).groupBy(key, period).agg(*[one(c).alias(c) for c in values])
    keys = df.select(key).distinct()
    g = once.groupBy(key).pivot(period, list(periods)).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values])
    g = keys.join(g, keys[key].eqNullSafe(g[key]), "left").drop(g[key])
    ren = {}
    for p in periods:
        for c in values:
            src = f"{p}_{c}" if len(values) > 1 else f"{p}"
            ren[src] = f"{c}_{p}"
    return g.withColumnsRenamed(ren)


def melt_predictions(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str] | None = None,
                     prefix: str = "composite_score_", seed_sep: str = "_seed_") -> DataFrame:
    """Wide prediction columns → ``(ids…, model, seed, predicted_score)``.

    A column ``composite_score_{model}_seed_{s}`` gives ``model`` and the integer
    ``seed``; a column without the seed part gives ``seed`` NULL.
    """
    value_cols = list(value_cols or [c for c in df.columns if c.startswith(prefix)])
    long = df.unpivot(list(ids), value_cols, "_name", "predicted_score")
    name = F.regexp_replace(F.col("_name"), f"^{prefix}", "")
    parts = F.split(name, seed_sep)
    return long.select(
        *ids,
        parts.getItem(0).alias("model"),
        F.when(F.size(parts) > 1, parts.getItem(1).try_cast("int")).alias("seed"),
        F.col("predicted_score").cast("double").alias("predicted_score"),
    )


@dataclass
class OneHot:
    """Fitted one-hot vocabulary: column → sorted distinct non-null values."""
    values: dict[str, list]
    null_flag: bool = True

    def names(self) -> list[str]:
        out = []
        for c, vals in self.values.items():
            out += [sanitize_name(f"{c}__{v}") for v in vals]
            if self.null_flag:
                out.append(f"{c}__nan")
        return out

    def apply(self, df: DataFrame, drop_source: bool = True) -> DataFrame:
        """0/1 integer columns per fitted value (+ a null flag); unseen → all 0."""
        exprs = {}
        for c, vals in self.values.items():
            if c not in df.columns:
                continue
            for v in vals:
                exprs[sanitize_name(f"{c}__{v}")] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
            if self.null_flag:
                exprs[f"{c}__nan"] = F.when(F.col(c).isNull(), 1).otherwise(0)
        out = df.withColumns(exprs)
        if drop_source:
            out = out.drop(*[c for c in self.values if c in df.columns])
        return out


def fit_onehot(df: DataFrame, cols: Sequence[str], null_flag: bool = True) -> OneHot:
    """Distinct values per column in one job (stack + distinct), sorted.

    Every value becomes a column, so the caller names categorical columns; for
    identifiers use `participation.dense_codes`.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return OneHot({}, null_flag)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols
    ])).alias("s")).select("s.c", "s.v").where(F.col("v").isNotNull()).distinct()
    rows = stacked.collect()
    vals: dict[str, list] = {c: [] for c in cols}
    types = {f.name: f.dataType for f in df.schema.fields}
    for r in rows:
        vals[r["c"]].append(r["v"])
    for c in cols:
        t = types[c].simpleString()
        if t in ("int", "bigint", "smallint", "tinyint"):
            vals[c] = sorted(int(v) for v in vals[c])
        elif t in ("double", "float"):
            vals[c] = sorted(float(v) for v in vals[c])
        else:
            vals[c] = sorted(vals[c])
    return OneHot(vals, null_flag)
