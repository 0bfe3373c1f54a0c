"""Group-statistics plans (A10–A25, W1) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import groupstats as gs
from .fixtures import fixture, with_fixtures
from .registry import register

LONG_KEYS = ("g1", "g2")
LONG_ORDER = ("uid", "line", "composite_score")


def _stats_sql(table: str, keys: list[str], cols: list[str], value: str = "composite_score") -> str:
    """DuckDB statement for the requested statistics, built from its own built-ins."""
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    exprs = {
        "min": "min(v)", "max": "max(v)", "mean": "avg(v)", "std": "stddev_samp(v)",
        "skew": "CASE WHEN count(v) < 3 THEN NULL WHEN var_pop(v) = 0 THEN 0.0 ELSE skewness(v) END",
        "median": "quantile_cont(v, 0.5)",
        "range": "max(v) - min(v)",
        "iqr": "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)",
        "mad": "avg(abs(v - gmean_v))",
        "cv": "CASE WHEN avg(v) = 0 THEN 0.0 ELSE stddev_samp(v) / avg(v) END",
        "gini": "CASE WHEN sum(v) = 0 THEN 0.0 ELSE sum((2 * rn - cnt - 1) * v) / (max(cnt) * sum(v)) END",
        "entropy": "entropy(v) * ln(2)",
        "harmonic_mean": "CASE WHEN min(v) > 0 AND count(*) = count(v) THEN count(v) / sum(1.0 / v) ELSE 0.0 END",
        "geometric_mean": "CASE WHEN min(v) > 0 AND count(*) = count(v) THEN exp(avg(ln(v))) ELSE 0.0 END",
        "q1_20": "quantile_cont(v, 0.2)", "q2_40": "quantile_cont(v, 0.4)",
        "q3_60": "quantile_cont(v, 0.6)", "q4_80": "quantile_cont(v, 0.8)",
    }
    sel = ",\n       ".join(f"round(CAST({exprs[c]} AS DOUBLE), 6) AS {c}" for c in cols)
    return f"""
WITH b AS (SELECT {k}, CAST({value} AS DOUBLE) AS v FROM {table} WHERE {nn}),
w AS (SELECT {k}, v, avg(v) OVER (PARTITION BY {k}) AS gmean_v,
             row_number() OVER (PARTITION BY {k} ORDER BY v) AS rn,
             count(v) OVER (PARTITION BY {k}) AS cnt FROM b)
SELECT {k},
       {sel}
FROM w GROUP BY {k}"""


def _peaks_sql(table: str, keys: list[str], order: list[str], value: str = "composite_score") -> str:
    k = ", ".join(keys)
    o = ", ".join(order)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""
WITH s AS (SELECT {k}, {o}, {value} AS v,
                  lag({value}) OVER (PARTITION BY {k} ORDER BY {o}) AS pv
           FROM {table} WHERE {nn} AND {value} IS NOT NULL),
r AS (SELECT {k}, {o}, v FROM s WHERE pv IS NULL OR v <> pv),
r2 AS (SELECT {k}, v, lag(v) OVER (PARTITION BY {k} ORDER BY {o}) AS a,
              lead(v) OVER (PARTITION BY {k} ORDER BY {o}) AS z FROM r)
SELECT {k}, count(*) FILTER (WHERE v > a AND v > z) AS peaks,
       count(*) FILTER (WHERE v < a AND v < z) AS troughs
FROM r2 GROUP BY {k}"""


def _plan(fix: str, keys, cols):
    def build(spark, sf_dir):
        df = fixture(spark, sf_dir, fix)
        return round_doubles(gs.order_free_stats(df, list(keys), "composite_score")
                             .select(*keys, *cols))
    return build


def _reg(name, fix, keys, cols):
    register(name, with_fixtures(_stats_sql(fix, list(keys), list(cols)), fix))(
        _plan(fix, keys, cols))


_reg("group_stats_basic", "f_labels_nullkey", ["grp"], ["min", "max", "mean", "std", "median", "range"])
_reg("group_stats_shape", "f_long_scores", LONG_KEYS, ["skew", "cv", "mad", "iqr"])
_reg("group_gini", "f_long_scores", LONG_KEYS, ["gini"])
_reg("group_entropy", "f_long_scores", LONG_KEYS, ["entropy"])
_reg("group_hmean_gmean", "f_labels_nullkey", ["grp"], ["harmonic_mean", "geometric_mean"])
_reg("group_quintiles", "f_long_scores", LONG_KEYS, ["q1_20", "q2_40", "q3_60", "q4_80"])
_reg("group_stats_uid_year", "f_predictions", ["model", "seed"],
     [c for c in gs.ORDER_FREE])


@register("group_peaks_troughs",
          with_fixtures(_peaks_sql("f_long_scores", list(LONG_KEYS), list(LONG_ORDER)), "f_long_scores"))
def group_peaks_troughs(spark, sf_dir):
    df = fixture(spark, sf_dir, "f_long_scores")
    return gs.peaks_troughs(df, list(LONG_KEYS), "composite_score", list(LONG_ORDER))


# Per-uid peaks over many short groups (one group per order key): exercises
# segments that start and end inside range partitions.
@register("group_peaks_per_order",
          with_fixtures(_peaks_sql("f_long_scores", ["uid"], ["line", "composite_score"]),
                        "f_long_scores"))
def group_peaks_per_order(spark, sf_dir):
    df = fixture(spark, sf_dir, "f_long_scores")
    return gs.peaks_troughs(df, ["uid"], "composite_score", ["line", "composite_score"])


_MULTI_VARS = ["g1", "g2"]


@register("group_stats_multi_key", with_fixtures(f"""
WITH st AS (
  SELECT 'g1' AS group_var, CAST(g1 AS VARCHAR) AS group_value, uid, line, composite_score FROM f_long_scores
  UNION ALL
  SELECT 'g2', CAST(g2 AS VARCHAR), uid, line, composite_score FROM f_long_scores),
stats AS ({_stats_sql('st', ['group_var', 'group_value'], list(gs.ORDER_FREE))}),
pk AS ({_peaks_sql('st', ['group_var', 'group_value'], list(LONG_ORDER))})
SELECT stats.*, pk.peaks, pk.troughs FROM stats JOIN pk USING (group_var, group_value)
""", "f_long_scores"))
def group_stats_multi_key(spark, sf_dir):
    df = fixture(spark, sf_dir, "f_long_scores")
    return round_doubles(gs.group_stats_multi(df, _MULTI_VARS, "composite_score", list(LONG_ORDER)))


@register("group_stats_joined", with_fixtures(f"""
WITH stats AS ({_stats_sql('f_labels_nullkey', ['grp'], ['mean', 'std', 'median', 'gini'])})
SELECT l.uid, l.year, l.composite_score, l.grp,
       stats.mean AS grp__mean, stats.std AS grp__std, stats.median AS grp__median,
       stats.gini AS grp__gini
FROM f_labels_nullkey l LEFT JOIN stats ON l.grp = stats.grp
""", "f_labels_nullkey"))
def group_stats_joined(spark, sf_dir):
    """Statistics of the training rows joined back to every row (J3); null keys get NULLs."""
    df = fixture(spark, sf_dir, "f_labels_nullkey")
    st = gs.order_free_stats(df, ["grp"], "composite_score").select(
        F.col("grp").alias("group_value"), F.lit("grp").alias("group_var"),
        "mean", "std", "median", "gini")
    st = round_doubles(st)
    return gs.join_group_stats(df, st, ["grp"], ["mean", "std", "median", "gini"])
