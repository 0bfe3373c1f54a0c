"""Per-group distribution statistics.

Design for scale
----------------
* **Compress first.** Rows are aggregated to ``(keys…, value, count)`` with a
  partial (map-side) aggregation, so the shuffle carries one row per distinct
  value per group instead of one per input row. A hot group holding a third of
  all rows is split across map tasks by the partial aggregate and arrives at
  the reducers already compressed.
* **Rank statistics from cumulative counts.** Median, quintiles, IQR and Gini
  need sorted order. On the compressed table each distinct value knows how many
  smaller values exist (a running sum of counts), which gives exact
  linear-interpolated quantiles (pandas' default) and the rank identity for
  Gini (``Σ(2i−n−1)x₍ᵢ₎ / (nΣx)``) without an O(n²) pair sum.
* **One aggregation for every statistic.** All moments, rank statistics,
  entropy and means come out of a single ``groupBy`` over the compressed
  table; many grouping columns are stacked into one long table
  (``group_stats_multi``) so the data is scanned and shuffled once.
* **Order-dependent counts (peaks / troughs)** are the only statistics that
  need the original row order. They use a range-partitioned sort over
  ``(keys, order…)`` so a hot group spans many tasks, a per-partition summary
  (first/last value, first/last direction, interior counts) and an exact
  associative merge of those summaries, whose groups have at most one row per
  partition.

Null rules (pandas semantics): rows with a null key are dropped before
grouping; null values are ignored by every statistic, except that the harmonic
and geometric means are 0 unless *all* values of the group are > 0 (a null
fails that test).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import prefix_sums

# The statistic names and quintile labels of the reference's
# group-statistics block, in its order.
STAT_NAMES = (
    "min", "max", "mean", "std", "skew", "median", "range", "iqr", "mad", "cv",
    "gini", "entropy", "harmonic_mean", "geometric_mean", "peaks", "troughs",
    "q1_20", "q2_40", "q3_60", "q4_80",
)
QUINTILES = (("q1_20", 0.2), ("q2_40", 0.4), ("q3_60", 0.6), ("q4_80", 0.8))
ORDER_FREE = tuple(s for s in STAT_NAMES if s not in ("peaks", "troughs"))

_V, _C = "_v", "_c"


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _not_null(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys…, _v, _c)``: count of each distinct value per group (nulls kept)."""
    keys = _as_list(keys)
    return (
        df.where(_not_null(keys))
        .select(*keys, F.col(value).cast("double").alias(_V))
        .groupBy(*keys, _V)
        .agg(F.count(F.lit(1)).alias(_C))
    )


def _quantile(q: float, n: Column, v: Column, c: Column, before: Column) -> Column:
    """Exact linear-interpolated quantile from a sorted compressed table.

    Position ``h = (n−1)·q``; ``lo = floor(h)``. The value at sorted index ``k``
    is the one whose block ``[before, before + c)`` contains ``k``.
    """
    h = (n - 1) * F.lit(q)
    lo = F.floor(h)
    frac = h - lo
    hi = F.least(lo + 1, n - 1)
    v_lo = F.max(F.when((before <= lo) & (lo < before + c), v))
    v_hi = F.max(F.when((before <= hi) & (hi < before + c), v))
    return v_lo + (v_hi - v_lo) * F.max(frac)


def order_free_stats(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """Every statistic except peaks/troughs, one row per non-null key.

    How many smaller values a distinct value has in its group is a running sum of
    counts over a range partitioning of the compressed table, for groups of any
    size: a group with very many distinct values is spread over many tasks.
    """
    keys = _as_list(keys)
    v, c = F.col(_V), F.col(_C)
    nn = v.isNotNull()
    vc = value_counts(df, keys, value).withColumn("_cn", F.when(nn, c).otherwise(F.lit(0)))
    cum = prefix_sums(vc, _V, ["_cn"], keys=keys)
    # per-group totals: one row per group
    tot = cum.groupBy(*keys).agg(F.sum("_cn").alias("_n"), F.sum(F.when(nn, c * v)).alias("_sum"))
    vc = cum.withColumn("_before", (F.col("_cn_cum") - F.col("_cn")).cast("long")).join(tot, keys)
    n, s, before = F.col("_n"), F.col("_sum"), F.col("_before")
    mean = F.try_divide(s, n)
    dev = v - mean
    nf = F.max(n).cast("double")
    m2 = F.sum(F.when(nn, c * dev * dev))
    m3 = F.sum(F.when(nn, c * dev * dev * dev))
    tot = F.max(s)
    agg = vc.groupBy(*keys).agg(
        nf.alias("_nf"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.max(mean).alias("mean"),
        m2.alias("_m2"),
        m3.alias("_m3"),
        _quantile(0.5, n, v, c, before).alias("median"),
        _quantile(0.25, n, v, c, before).alias("_q25"),
        _quantile(0.75, n, v, c, before).alias("_q75"),
        *[_quantile(q, n, v, c, before).alias(name) for name, q in QUINTILES],
        F.try_divide(F.sum(F.when(nn, c * F.abs(dev))), nf).alias("mad"),
        tot.alias("_tot"),
        F.sum(F.when(nn, v * c * (2 * before + c - n))).alias("_gini_num"),
        (-F.sum(F.when(nn, (c / n) * F.log(c / n)))).alias("entropy"),
        F.sum(F.when(nn & (v != 0), c / v)).alias("_inv"),
        F.sum(F.when(nn, c * F.log(F.when(v > 0, v)))).alias("_logsum"),
        F.sum(F.when(~nn, c).otherwise(F.lit(0))).alias("_nulls"),
    )
    nfc, m2c, m3c = F.col("_nf"), F.col("_m2"), F.col("_m3")
    var_s = m2c / (nfc - 1)
    std = F.when(nfc > 1, F.sqrt(var_s))
    g1 = (m3c / nfc) / F.pow(m2c / nfc, 1.5)
    skew = (
        F.when(nfc < 3, F.lit(None).cast("double"))
        .when(m2c == 0, F.lit(0.0))
        .otherwise(F.sqrt(nfc * (nfc - 1)) / (nfc - 2) * g1)
    )
    all_pos = (F.col("min") > 0) & (F.col("_nulls") == 0)
    out = agg.select(
        *keys,
        "min", "max", "mean",
        std.alias("std"),
        skew.alias("skew"),
        "median",
        (F.col("max") - F.col("min")).alias("range"),
        (F.col("_q75") - F.col("_q25")).alias("iqr"),
        "mad",
        F.when(F.col("mean") == 0, F.lit(0.0)).otherwise(std / F.col("mean")).alias("cv"),
        F.when(F.col("_tot") == 0, F.lit(0.0))
        .otherwise(F.col("_gini_num") / (nfc * F.col("_tot"))).alias("gini"),
        "entropy",
        F.when(all_pos, nfc / F.col("_inv")).otherwise(F.lit(0.0)).alias("harmonic_mean"),
        F.when(all_pos, F.exp(F.col("_logsum") / nfc)).otherwise(F.lit(0.0)).alias("geometric_mean"),
        *[name for name, _ in QUINTILES],
    )
    return out


# --------------------------------------------------------------------------
# peaks / troughs


def _sign(x: float) -> int:
    return 1 if x > 0 else (-1 if x < 0 else 0)


def _merge(a: dict, b: dict) -> dict:
    """Associative merge of two run summaries of consecutive slices of one group.

    A summary holds the first/last value, the first/last non-zero direction of
    change, the number ``ns`` of non-zero directions and the counts of (+,−)
    and (−,+) direction pairs inside the slice. Pairs across the seam involve
    only a's last direction, the seam's own direction and b's first direction.
    """
    j = _sign(b["fv"] - a["lv"])
    seam = [s for s in (a["ls"], j, b["fs"]) if s != 0]
    pk = sum(1 for x, y in zip(seam, seam[1:]) if x > 0 and y < 0)
    tr = sum(1 for x, y in zip(seam, seam[1:]) if x < 0 and y > 0)
    fs = a["fs"] or j or b["fs"]
    ls = b["ls"] or j or a["ls"]
    return {"fv": a["fv"], "lv": b["lv"], "fs": fs, "ls": ls, "ns": a["ns"] + b["ns"] + abs(j),
            "pk": a["pk"] + b["pk"] + pk, "tr": a["tr"] + b["tr"] + tr}


_STATE = ("fv", "lv", "fs", "ls", "ns", "pk", "tr")


def _batch_segments(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """Vectorised summaries of the key segments of one sorted Arrow batch.

    One output row per run of equal keys: keys, first/last value, first/last
    non-zero direction, number of directions and interior (+,−)/(−,+) pairs.
    """
    n = len(pdf)
    v = pdf[_V].to_numpy(dtype="float64")
    new_seg = np.ones(n, dtype=bool)
    if n > 1:
        same = np.ones(n - 1, dtype=bool)
        for k in keys:
            col = pdf[k].to_numpy()
            same &= col[1:] == col[:-1]
        new_seg[1:] = ~same
    seg = np.cumsum(new_seg) - 1
    starts = np.flatnonzero(new_seg)
    ends = np.append(starts[1:], n) - 1
    nseg = len(starts)
    # directions of change inside each segment, zeros dropped
    d = np.sign(v[1:] - v[:-1])
    keep = (seg[1:] == seg[:-1]) & (d != 0)
    ds = d[keep].astype(np.int64)
    dseg = seg[1:][keep]
    fs = np.zeros(nseg, dtype=np.int64)
    ls = np.zeros(nseg, dtype=np.int64)
    pk = np.zeros(nseg, dtype=np.int64)
    tr = np.zeros(nseg, dtype=np.int64)
    ns = np.bincount(dseg, minlength=nseg).astype(np.int64)
    if len(ds):
        first_idx = np.flatnonzero(np.r_[True, dseg[1:] != dseg[:-1]])
        last_idx = np.r_[first_idx[1:] - 1, len(ds) - 1]
        fs[dseg[first_idx]] = ds[first_idx]
        ls[dseg[last_idx]] = ds[last_idx]
        pair = dseg[1:] == dseg[:-1]
        pk = np.bincount(dseg[1:][pair & (ds[:-1] > 0) & (ds[1:] < 0)], minlength=nseg)
        tr = np.bincount(dseg[1:][pair & (ds[:-1] < 0) & (ds[1:] > 0)], minlength=nseg)
    out = pdf[keys].iloc[starts].reset_index(drop=True)
    out["fv"], out["lv"] = v[starts], v[ends]
    out["fs"], out["ls"], out["ns"] = fs, ls, ns
    out["pk"], out["tr"] = pk.astype(np.int64), tr.astype(np.int64)
    return out


_SUMMARY = (("_pid", T.LongType()), ("fv", T.DoubleType()), ("lv", T.DoubleType()),
            ("fs", T.IntegerType()), ("ls", T.IntegerType()), ("ns", T.LongType()),
            ("pk", T.LongType()), ("tr", T.LongType()))


def _partition_summaries(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """One summary row per (group, range partition) from a sorted partition scan.

    Each Arrow batch is summarised with numpy; only the segment that continues
    from the previous batch is merged in Python (one row per batch).
    """
    key_fields = [ranged.schema[k] for k in keys]
    schema = T.StructType(key_fields + [T.StructField(n, t) for n, t in _SUMMARY])
    names = schema.fieldNames()

    def finish(frame: pd.DataFrame, pid: int) -> pd.DataFrame:
        frame = frame.copy()
        frame["_pid"] = pid
        return frame[names].astype({"fs": "int32", "ls": "int32"})

    def summarise(batches):
        pid = TaskContext.get().partitionId()
        carry = None  # last segment of the previous batch (may continue)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            segs = _batch_segments(pdf, keys)
            if carry is not None:
                same_key = all(carry.iloc[0][k] == segs.iloc[0][k] for k in keys)
                if same_key:
                    merged = _merge({c: carry.iloc[0][c] for c in _STATE},
                                    {c: segs.iloc[0][c] for c in _STATE})
                    for c in _STATE:
                        segs.at[0, c] = merged[c]
                else:
                    yield finish(carry, pid)
            if len(segs) > 1:
                yield finish(segs.iloc[:-1], pid)
            carry = segs.iloc[-1:].reset_index(drop=True)
        if carry is not None:
            yield finish(carry, pid)

    return ranged.mapInPandas(summarise, schema=schema)


def peaks_troughs(df: DataFrame, keys: str | Sequence[str], value: str,
                  order_by: Sequence[str]) -> DataFrame:
    """Interior strict local maxima / minima per group along ``order_by``.

    A flat top counts once; the first and last runs are never peaks (scipy
    ``find_peaks`` semantics). Equal to counting (+,−) and (−,+) pairs of
    consecutive non-zero changes.

    Plan: range-partition on ``(keys, order…)`` — a hot group is split over
    many tasks — and sort within partitions; one vectorised pass per partition
    emits a summary per (group, partition). Seams between partitions are then
    resolved with built-in window functions over the summaries, whose groups
    hold at most one row per partition.
    """
    keys = _as_list(keys)
    order_by = _as_list(order_by)
    base = df.where(_not_null(keys) & F.col(value).isNotNull()).select(
        *keys, *order_by, F.col(value).cast("double").alias(_V))
    # no fixed count: AQE may merge small neighbouring ranges, which keeps their order
    ranged = base.repartitionByRange(*keys, *order_by) \
        .sortWithinPartitions(*keys, *order_by)
    return _resolve_seams(_partition_summaries(ranged, keys), keys)


def _resolve_seams(segs: DataFrame, keys: list[str]) -> DataFrame:
    """Exact peaks/troughs per group from its per-partition summaries (≤ 1 row per partition)."""
    w = Window.partitionBy(*keys).orderBy("_pid")
    segs = segs.withColumn("_seam", F.signum(F.col("fv") - F.lag("lv").over(w)).cast("int"))
    # Boundary tokens in order: seam direction, first direction, last direction
    # (the last only when it is a different change than the first). Interior
    # counts ride on the seam token so the summaries are read once.
    nz = lambda c: F.when(c != 0, c)
    tokens = segs.select(*keys, "_pid", F.explode(F.array(
        F.struct(F.lit(0).alias("pos"), nz(F.col("_seam")).alias("tok"),
                 F.col("pk").alias("ipk"), F.col("tr").alias("itr")),
        F.struct(F.lit(1).alias("pos"), nz(F.when(F.col("ns") >= 1, F.col("fs"))).alias("tok"),
                 F.lit(0).cast("long").alias("ipk"), F.lit(0).cast("long").alias("itr")),
        F.struct(F.lit(2).alias("pos"), nz(F.when(F.col("ns") >= 2, F.col("ls"))).alias("tok"),
                 F.lit(0).cast("long").alias("ipk"), F.lit(0).cast("long").alias("itr")),
    )).alias("t")).select(*keys, "_pid", "t.pos", "t.tok", "t.ipk", "t.itr")
    before = Window.partitionBy(*keys).orderBy("_pid", "pos") \
        .rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(F.when(F.col("tok").isNotNull(), F.struct("_pid", "pos", "tok")),
                  ignorenulls=True).over(before)
    tokens = tokens.withColumn("_prev", prev)
    # first and last direction of one partition's slice are not neighbours
    internal = (F.col("_prev._pid") == F.col("_pid")) & (F.col("_prev.pos") == 1) & (F.col("pos") == 2)
    cross = F.col("tok").isNotNull() & F.col("_prev").isNotNull() & ~internal
    return tokens.groupBy(*keys).agg(
        (F.sum("ipk") + F.count(F.when(cross & (F.col("_prev.tok") > 0) & (F.col("tok") < 0), 1)))
        .alias("peaks"),
        (F.sum("itr") + F.count(F.when(cross & (F.col("_prev.tok") < 0) & (F.col("tok") > 0), 1)))
        .alias("troughs"))


# --------------------------------------------------------------------------
# public entry points


def group_stats(df: DataFrame, keys: str | Sequence[str], value: str = "composite_score",
                order_by: Sequence[str] | None = None) -> DataFrame:
    """All reference statistics per group, in the reference's column order.

    ``order_by`` names the row order for peaks/troughs; without it those two
    columns are omitted (the reference relies on file order, which a
    distributed table does not have).
    """
    keys = _as_list(keys)
    base = order_free_stats(df, keys, value)
    if order_by:
        pt = peaks_troughs(df, keys, value, order_by)
        base = base.join(pt, keys, "left")
        cols = [*keys, *STAT_NAMES]
    else:
        cols = [*keys, *ORDER_FREE]
    return base.select(*cols)


def stack_group_vars(df: DataFrame, group_vars: Sequence[str], value: str,
                     order_by: Sequence[str] = ()) -> DataFrame:
    """``(group_var, group_value, order…, value)``: one row per input row and group var.

    Group values are cast to string so different key types share one column.
    Missing grouping columns are skipped (schema guard of the reference).
    """
    present = [g for g in group_vars if g in df.columns]
    if not present:
        raise ValueError("none of the grouping columns exist")
    pairs = F.array(*[
        F.struct(F.lit(g).alias("group_var"), F.col(g).cast("string").alias("group_value"))
        for g in present
    ])
    return df.select(F.explode(pairs).alias("_gv"), *order_by, value).select(
        "_gv.group_var", "_gv.group_value", *order_by, value)


def missing_group_vars(df: DataFrame, group_vars: Sequence[str]) -> list[str]:
    """Grouping columns that ``df`` does not have and the statistics skip."""
    return [g for g in group_vars if g not in df.columns]


def group_stats_multi(df: DataFrame, group_vars: Sequence[str], value: str = "composite_score",
                      order_by: Sequence[str] | None = None) -> DataFrame:
    """Statistics for many single-column groupings in one pass.

    Long output ``(group_var, group_value, stats…)``. Everything aggregates the
    stacked ``(group_var, group_value, value)`` rows; for peaks/troughs they are
    range-partitioned by (column, value, order), whatever a column's cardinality.
    """
    keys = ["group_var", "group_value"]
    stacked = stack_group_vars(df, group_vars, value, order_by or ())
    stats = order_free_stats(stacked, keys, value)
    if not order_by:
        return stats.select(*keys, *ORDER_FREE)
    pt = peaks_troughs(stacked, keys, value, order_by)
    return stats.join(pt, keys, "left").select(*keys, *STAT_NAMES)


def join_group_stats(df: DataFrame, stats_long: DataFrame, group_vars: Sequence[str],
                     stats: Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """Left-join long statistics back to rows, one block per group variable.

    Column names are ``{group_var}__{prefix}{stat}`` (never positional suffixes). The
    statistics table has one row per distinct group value; the planner chooses
    the join from its size at run time.
    """
    stats = list(stats or [c for c in stats_long.columns if c not in ("group_var", "group_value")])
    present = [g for g in group_vars if g in df.columns]
    out = df
    for g in present:
        block = stats_long.where(F.col("group_var") == g).select(
            F.col("group_value").alias(f"_{g}__key"),
            *[F.col(s).alias(f"{g}__{prefix}{s}") for s in stats])
        out = out.join(block, out[g].cast("string") == block[f"_{g}__key"], "left") \
            .drop(f"_{g}__key")
    return out
