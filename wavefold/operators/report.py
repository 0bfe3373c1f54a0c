"""Evaluation report operators.

Every report is one aggregation over a long predictions table
``(…, uid, year, model, seed, predicted_score, composite_score)``. Several
grouping columns are stacked into ``(group_var, group)`` rows so one shuffle
serves all of them. Bootstrap replicates are Poisson weights derived from a
hash of ``(row id, replicate, seed)``: no resampling, no driver loop, and the
replicate sums are vectors that merge by addition, so only ``groups × replicates``
values of a task are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col_or


def sq_err(pred: str = "predicted_score", truth: str = "composite_score") -> Column:
    d = F.col(pred) - F.col(truth)
    return d * d


def rmse(df: DataFrame, by: Sequence[str] = (), pred: str = "predicted_score",
         truth: str = "composite_score") -> DataFrame:
    """RMSE and row count per group (A26, A27); global when ``by`` is empty."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.sqrt(F.avg(sq_err(pred, truth))).alias("rmse"),
                 F.count(F.lit(1)).alias("num_samples"))


def mae(df: DataFrame, by: Sequence[str] = (), pred: str = "predicted_score",
        truth: str = "composite_score") -> DataFrame:
    """Mean absolute error per group."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.avg(F.abs(F.col(pred) - F.col(truth))).alias("mae"),
                 F.count(F.lit(1)).alias("num_samples"))


def attach_truth(preds: DataFrame, labels: DataFrame, keys: Sequence[str] = ("uid", "year")) -> DataFrame:
    """Left join of the true score onto long predictions."""
    return preds.join(labels.select(*keys, "composite_score"), list(keys), "left")


def stack_groups(df: DataFrame, group_cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``(group_var, group, keep…)``: one row per input row and grouping column."""
    arr = F.array(*[F.struct(F.lit(g).alias("group_var"),
                             F.col(g).cast("string").alias("group")) for g in group_cols])
    return df.select(F.explode(arr).alias("_g"), *keep).select("_g.group_var", "_g.group", *keep)


def rmse_by_groups(df: DataFrame, group_cols: Sequence[str], by: Sequence[str] = ("model",),
                   pred: str = "predicted_score", truth: str = "composite_score") -> DataFrame:
    """RMSE per ``(group_var, group, by…)`` for many grouping columns at once."""
    st = stack_groups(df, group_cols, [*by, pred, truth])
    return rmse(st, ["group_var", "group", *by], pred, truth)


def fairness(rmse_table: DataFrame, by: Sequence[str] = ("group_var", "model"),
             null_groups: bool = True) -> DataFrame:
    """``1 − (max − min) / max`` of the group RMSEs.

    pandas ``groupby`` drops a null group before the RMSE table is built; with
    ``null_groups=False`` those rows are excluded here as well.
    """
    t = rmse_table if null_groups else rmse_table.where(F.col("group").isNotNull())
    return t.groupBy(*by).agg(
        (1 - F.try_divide(F.max("rmse") - F.min("rmse"), F.max("rmse"))).alias("fairness"))


# The labels of the two fold types in the reference's report.
TWO_YEARS, ONE_YEAR = "two_year_scores", "one_years_scores"


def fold_stability(df: DataFrame, fold: str = "combined_fold", by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample std of the per-fold RMSE by fold type (A7), within ``by``.

    The fold type is TWO_YEARS when the key-level fold (text before ``_``) is > 0, else ONE_YEAR.
    """
    per_fold = rmse(df, [*by, fold])
    ftype = F.when(F.split(F.col(fold), "_").getItem(0).cast("double") > 0, F.lit(TWO_YEARS)).otherwise(F.lit(ONE_YEAR))
    return per_fold.withColumn("fold_type", ftype).groupBy(*by, "fold_type").agg(
        F.avg("rmse").alias("rmse"), F.stddev_samp("rmse").alias("std"))


def seed_stability(df: DataFrame, key: str = "uid", seed: str = "seed",
                   pred: str = "predicted_score", by: Sequence[str] = ()) -> DataFrame:
    """Seed stability as ``(by…, metric, value)`` rows.

    ``rmse_mean`` / ``rmse_std``: mean and sample std of the per-seed RMSE;
    ``mean_uid_std``: mean over keys of the per-key prediction std.
    """
    by = list(by)
    a = rmse(df, [*by, seed]).groupBy(*by).agg(F.avg("rmse").alias("rmse_mean"), F.stddev_samp("rmse").alias("rmse_std"))
    b = df.groupBy(*by, key).agg(F.stddev_samp(pred).alias("_s")).groupBy(*by).agg(F.avg("_s").alias("mean_uid_std"))
    return (a.unpivot(by, ["rmse_mean", "rmse_std"], "metric", "value")
            .unionByName(b.unpivot(by, ["mean_uid_std"], "metric", "value")))


def pivot_rmse(df: DataFrame, rows: str, cols: str, values: Sequence, pred: str = "predicted_score",
               truth: str = "composite_score") -> DataFrame:
    """RMSE table with ``rows`` down and the explicit ``values`` of ``cols`` across."""
    return df.groupBy(rows).pivot(cols, list(values)).agg(F.sqrt(F.avg(sq_err(pred, truth))))


def top_bottom(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """Bottom-n and top-n rows by ``col``, concatenated (W3). The limit is the feature."""
    top = df.orderBy(F.desc(col)).limit(n)
    bottom = df.orderBy(F.asc(col)).limit(n)
    return bottom.unionByName(top)


def percent_change(value: str | Column, baseline: str | Column) -> Column:
    """``(x − b) / b · 100``."""
    x, b = col_or(value), col_or(baseline)
    return F.try_divide(x - b, b) * 100


def scale_se(se: str | Column, n: str | Column, total: str | Column) -> Column:
    """``se · sqrt(n / total)``."""
    return col_or(se) * F.sqrt(F.try_divide(col_or(n).cast("double"), col_or(total)))


def scale_interval(lower: str | Column, upper: str | Column, n: str | Column,
                   total: str | Column) -> tuple[Column, Column]:
    """Shrink an interval around its centre by ``sqrt(n / total)``."""
    lo, hi = col_or(lower), col_or(upper)
    mid, half = (hi + lo) / 2, (hi - lo) / 2 * F.sqrt(F.try_divide(col_or(n).cast("double"), col_or(total)))
    return mid - half, mid + half


def poisson1_thresholds(kmax: int = 12) -> list[float]:
    """Cumulative probabilities of Poisson(1) for k = 0..kmax−1 (inverse-CDF sampling).

    The sampler draws at most ``kmax``: the tail beyond, about 6e-11 of the mass at
    12, is drawn as 12. That is a property of the sampler, stated here.
    """
    out, acc = [], 0.0
    for k in range(kmax):
        acc += math.exp(-1.0) / math.factorial(k)
        out.append(acc)
    return out


def poisson_weight(u: Column, kmax: int = 12) -> Column:
    """Poisson(1) draw from a uniform ``u`` by inverse CDF."""
    th = poisson1_thresholds(kmax)
    expr = F.when(u < th[0], F.lit(0))
    for k in range(1, kmax):
        expr = expr.when(u < th[k], F.lit(k))
    return expr.otherwise(F.lit(kmax))


HASH_PRIME = 2147483647  # 2^31 − 1


def replicate_hashes(*row_id: str, seed: int = 42) -> list[Column]:
    """Two 32-bit integers from one md5 of ``(row id…, seed)`` per row."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in row_id], F.lit(str(seed))))
    return [F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint").alias("_h1"),
            F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint").alias("_h2")]


def replicate_uniform(h1: str, h2: str, b: str) -> Column:
    """Uniform for replicate ``b`` by double hashing: ``((h1 + b·h2) mod p) / p``.

    For a fixed replicate the values are independent across rows, so every
    replicate is a valid Poisson bootstrap; only one md5 per row is computed.
    """
    return F.pmod(F.col(h1) + F.col(b).cast("bigint") * F.col(h2), F.lit(HASH_PRIME)) / F.lit(float(HASH_PRIME))


#: Rows whose weights stand in memory at once, and groups whose sums a task holds before it passes them on.
BOOT_ROWS, BOOT_GROUPS = 64, 2_000
#: Bits of a drawn number that the table of weights leaves out, and its mark for cells that need the whole number.
BOOT_CELL, BOOT_LOOK = 15, 255


@lru_cache(1)
def _weight_table() -> tuple[np.ndarray, np.ndarray]:
    """``(thresholds, table)``: the smallest integers at or above the Poisson thresholds, and the weight of every
    cell of 2 ** BOOT_CELL numbers, or BOOT_LOOK where a threshold or the modulus lies in the cell."""
    limits = []
    for th in poisson1_thresholds():
        x = int(th * HASH_PRIME) - 2
        while x / HASH_PRIME < th:
            x += 1
        limits.append(x)
    limits = np.array(limits, np.int64)
    first = np.arange((HASH_PRIME >> BOOT_CELL) + 2, dtype=np.int64) << BOOT_CELL
    low, high = (np.searchsorted(limits, first + k, side="right") for k in (0, (1 << BOOT_CELL) - 1))
    table = np.where((low == high) & (first + (1 << BOOT_CELL) <= HASH_PRIME), low, BOOT_LOOK).astype(np.uint8)
    return limits, table


def poisson_weights(h1: np.ndarray, h2: np.ndarray, n_boot: int) -> np.ndarray:
    """The weights of ``poisson_weight(replicate_uniform(...))``: a row for each row, a column for each replicate."""
    limits, table = _weight_table()
    x = h2[:, None] * np.arange(n_boot, dtype=np.int64)
    x += h1[:, None]
    drawn = x >> 31
    x &= HASH_PRIME
    x += drawn  # the same modulo 2^31 - 1, and at most one modulus too large
    weights = table[x >> BOOT_CELL]
    look = np.nonzero(weights == BOOT_LOOK)
    weights[look] = np.searchsorted(limits, x[look] % HASH_PRIME, side="right")
    return weights.astype(np.float64)


def bootstrap_replicates(df: DataFrame, value: str, by: Sequence[str], row_id: Sequence[str],
                         n_boot: int = 200, seed: int = 42) -> DataFrame:
    """``(by…, b, mean_b)``: replicate means with Poisson(1) weights.

    A task turns its rows into a matrix of weights, some rows at a time, and adds up two vectors
    for each group: of weighted values and of weights, over all replicates. Vectors of the
    same group merge by addition, so no row is ever expanded by the replicates: a task
    ships at most a vector pair for each of its groups (and BOOT_GROUPS at a time, if it has more).
    Rows without a value count in the weights' vector as they always have; a group without any drawn value has no mean.
    """
    keys = df.select(*by).schema
    names = [f.name for f in keys.fields]
    x = df.select(*by, F.col(value).cast("double").alias("_value"), *replicate_hashes(*row_id, seed=seed))
    schema = T.StructType([*keys.fields, T.StructField("_sums", T.ArrayType(T.DoubleType())),
                           T.StructField("_weights", T.ArrayType(T.DoubleType())), T.StructField("_valued", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        types = None

        def passed_on() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [pa.array(column, t) for column, t in zip(zip(*held), types)] if names else []
                columns += [pa.array([v[i].tolist() for v in held.values()], pa.list_(pa.float64())) for i in (0, 1)]
                columns.append(pa.array([v[2] for v in held.values()]))
                yield pa.RecordBatch.from_arrays(columns, [*names, "_sums", "_weights", "_valued"])
                held.clear()

        for batch in batches:
            types = types or [batch.schema.field(i).type for i in range(len(names))]
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(len(names))))) if names else [()] * batch.num_rows
            numbers: dict[tuple, int] = {}
            group = np.fromiter((numbers.setdefault(r, len(numbers)) for r in rows), np.int64, len(rows))
            given = batch.column(len(names))
            values = given.fill_null(0.0).to_numpy(zero_copy_only=False)
            valued = given.is_valid().to_numpy(zero_copy_only=False)
            h1, h2 = (batch.column(len(names) + i).to_numpy(zero_copy_only=False) for i in (1, 2))
            order = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[order], np.arange(len(numbers) + 1))
            for key, start, end in zip(numbers, edges[:-1].tolist(), edges[1:].tolist()):
                sums = held.setdefault(key, [np.zeros(n_boot), np.zeros(n_boot), False])
                for at in range(start, end, BOOT_ROWS):
                    some = order[at:min(at + BOOT_ROWS, end)]
                    weights = poisson_weights(h1[some], h2[some], n_boot)
                    sums[0] += values[some] @ weights
                    sums[1] += weights.sum(axis=0)
                sums[2] |= bool(valued[order[start:end]].any())
                if len(held) >= BOOT_GROUPS:
                    yield from passed_on()
        yield from passed_on()

    vectors = x.mapInArrow(run, schema)
    places = F.arrays_zip("_sums", "_weights")
    each = vectors.select(*by, "_valued", F.posexplode(places).alias("b", "_v"))
    return each.groupBy(*by, "b").agg(
        # a replicate that drew no row of a small group has no mean (NULL, skipped by the SE)
        F.when(F.max("_valued"), F.try_divide(F.sum("_v._sums"), F.sum("_v._weights"))).alias("mean_b"))


def bootstrap_se(df: DataFrame, value: str, by: Sequence[str], row_id: Sequence[str],
                 n_boot: int = 200, seed: int = 42) -> DataFrame:
    """``(by…, n, mean, se)``: the group mean and the bootstrap standard error."""
    reps = bootstrap_replicates(df, value, by, row_id, n_boot, seed)
    se = reps.groupBy(*by).agg(F.stddev_samp("mean_b").alias("se"))
    base = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    return base.join(se, list(by), "left")


def bootstrap_difference(df: DataFrame, value: str, by: Sequence[str], category: str,
                         treated, control, row_id: Sequence[str], n_boot: int = 200,
                         seed: int = 42) -> DataFrame:
    """Mean difference treated − control and its paired-replicate SE.

    Output ``(by…, n_treated, n_control, mean_diff, se_diff)``.
    """
    sub = df.where(F.col(category).isin(treated, control))
    reps = bootstrap_replicates(sub, value, [*by, category], row_id, n_boot, seed)
    t = F.when(F.col(category) == F.lit(treated), F.col("mean_b"))
    c = F.when(F.col(category) == F.lit(control), F.col("mean_b"))
    diffs = reps.groupBy(*by, "b").agg((F.max(t) - F.max(c)).alias("d"))
    se = diffs.groupBy(*by).agg(F.stddev_samp("d").alias("se_diff"))
    tv = F.when(F.col(category) == F.lit(treated), F.col(value))
    cv = F.when(F.col(category) == F.lit(control), F.col(value))
    base = sub.groupBy(*by).agg(
        F.count(tv).alias("n_treated"), F.count(cv).alias("n_control"),
        (F.avg(tv) - F.avg(cv)).alias("mean_diff"))
    return base.join(se, list(by), "left")


def score_histogram(df: DataFrame, cols: Sequence[str], lo: float, hi: float, bins: int,
                    by: Sequence[str] = ()) -> DataFrame:
    """Counts per equal-width bucket for each score column (G12, re-aimed density plot).

    Bucket ``0`` is below ``lo``, ``bins + 1`` above ``hi`` (``width_bucket``).
    """
    st = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("x")) for c in cols
    ])).alias("s")).select(*by, "s.series", "s.x").where(F.col("x").isNotNull())
    b = F.expr(f"width_bucket(x, {float(lo)}, {float(hi)}, {int(bins)})")
    return st.groupBy(*by, "series", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def effect_band(df: DataFrame, value: str, scenario: str, row_id: Sequence[str], years: Sequence[int], n_train: int,
                year: str = "year", n_boot: int = 200, seed: int = 42) -> DataFrame:
    """Mean effect per scenario with its band, wide by year.

    The bootstrap SE is scaled by ``sqrt(n / (n + n_train))`` and the band once
    more around its centre by the same factor, as in the reference.
    """
    t = bootstrap_se(df, value, [scenario, year], row_id, n_boot, seed)
    total = F.col("n") + F.lit(n_train)
    se = scale_se("se", "n", total)
    lo, hi = scale_interval(F.col("mean") - se, F.col("mean") + se, "n", total)
    t = t.select(scenario, year, "mean", lo.alias("lower_bound"), hi.alias("upper_bound"))
    measures = ("mean", "lower_bound", "upper_bound")
    wide = t.groupBy(scenario).pivot(year, list(years)).agg(*(F.first(m).alias(m) for m in measures))
    return wide.withColumnsRenamed({f"{y}_{m}": f"{m}_{y}" for y in years for m in measures})


def year_flags(df: DataFrame, years_col: str, years: Sequence[int]) -> DataFrame:
    """``has_{y}`` 0/1 flags from an array of years."""
    return df.withColumns({f"has_{y}": F.array_contains(F.col(years_col), y).cast("int") for y in years})


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision ``Σ (R_n − R_{n−1}) P_n`` over distinct score thresholds.

    Rows are compressed to ``(by, score, positives, count)``; the running counts
    along descending score come from a distributed prefix sum.
    """
    from .quantiles import prefix_sums
    d = df.where(F.col(score).isNotNull()).groupBy(*by, score).agg(
        F.sum(F.col(label).cast("double")).alias("_pos"), F.count(F.lit(1)).cast("double").alias("_cnt"))
    c = prefix_sums(d, score, ["_pos", "_cnt"], keys=list(by), descending=True)
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * F.col("_pos_cum") / F.col("_cnt_cum")), F.sum("_pos"))
        .alias("average_precision"))


def participation_years(features: DataFrame, labels: DataFrame, first_wave_col: str, key: str = "uid",
                        first_year: int = 2003, second_year: int = 2012) -> DataFrame:
    """``(key, years, pattern)``: waves from a null test on a first-wave column ∪ label years."""
    waves = F.when(F.col(first_wave_col).isNull(), F.array(F.lit(second_year))) \
        .otherwise(F.array(F.lit(first_year), F.lit(second_year)))
    ly = labels.groupBy(key).agg(F.collect_list(F.col("year").cast("int")).alias("_ly"))
    x = features.select(key, waves.alias("_fy")).join(ly, key, "left")
    years = F.array_sort(F.concat("_fy", F.coalesce("_ly", F.array().cast("array<int>"))))
    return x.select(key, years.alias("years")).withColumn(
        "pattern", F.concat(F.lit("["), F.array_join("years", ", "), F.lit("]")))


def effect_table(df: DataFrame, value: str, feature: str, category: str, treated, control,
                 row_id: Sequence[str], years: Sequence[int], year: str = "year",
                 n_boot: int = 200, seed: int = 42) -> DataFrame:
    """Treated − control effect per feature with ±1 SE bands, wide by year.

    The SE is scaled by ``sqrt(n_t / (n_t + n_c))`` and the band is scaled again
    around its centre by the same factor, as in the reference (Q14).
    """
    t = bootstrap_difference(df, value, [feature, year], category, treated, control, row_id, n_boot, seed)
    total = F.col("n_treated") + F.col("n_control")
    se = scale_se("se_diff", "n_treated", total)
    lo, hi = scale_interval(F.col("mean_diff") - se, F.col("mean_diff") + se, "n_treated", total)
    t = t.select(feature, year, "mean_diff", lo.alias("lower_bound_diff"), hi.alias("upper_bound_diff"))
    wide = t.groupBy(feature).pivot(year, list(years)).agg(
        F.first("mean_diff").alias("mean_diff"), F.first("lower_bound_diff").alias("lower_bound_diff"),
        F.first("upper_bound_diff").alias("upper_bound_diff"))
    return wide.withColumnsRenamed({f"{y}_{m}": f"{m}_{y}" for y in years
                                    for m in ("mean_diff", "lower_bound_diff", "upper_bound_diff")})
