"""Exact global quantiles and running sums without funnelling a column through one task or the driver.

``F.percentile`` keeps a value → count map that is merged into a single task
for a global aggregate; on a continuous column at scale that map holds every
distinct value. Here the work is split:

1. ``groupBy(value).count()`` compresses repeated values (a hot value costs one
   row) with a map-side partial aggregate;
2. the compressed table is range-partitioned by value and checkpointed, so the
   partition bounds are fixed and each partition holds a contiguous value range;
3. per-partition counts (one row per column and partition) give each partition's
   first rank, and with it the partitions that hold the wanted ranks;
4. in those partitions running counts find the rows at the wanted ranks. Only
   those rows, two per quantile and column, reach the driver.

The result equals pandas' default linear interpolation.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


def values_at_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(k, q, lo, hi, frac)``: for column number ``k`` and quantile number ``q`` the two
    neighbouring order statistics and the weight of the second; columns without values have no row."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.k", "s.x").where(F.col("x").isNotNull())
    vc = stacked.groupBy("k", "x").agg(F.count(F.lit(1)).alias("c"))
    ranged = checkpoint(vc.repartitionByRange("k", "x").withColumn("p", F.spark_partition_id()))
    per = ranged.groupBy("k", "p").agg(F.sum("c").alias("n"))
    # windows over one row per (column, partition)
    before = Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "total", F.sum("n").over(Window.partitionBy("k")))
    quantiles = F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("prob")) for i, p in enumerate(probs)])
    h = (F.col("total") - 1) * F.col("prob")
    ranks = per.select("*", F.inline(quantiles)).withColumn("lo", F.floor(h)).withColumn("frac", h - F.floor(h))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("lo").alias("rank")),
                    F.struct(F.lit(1).alias("side"), F.least(F.col("lo") + 1, F.col("total") - 1).alias("rank")))
    wanted = ranks.select("k", "p", "n", "start", "q", "frac", F.inline(sides)).where(
        (F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("start") + F.col("n"))).select(
        "k", "p", "q", "frac", "side", (F.col("rank") - F.col("start")).alias("at"))
    wanted = checkpoint(wanted)  # two rows per quantile and column
    running = F.sum("c").over(Window.partitionBy("k", "p").orderBy("x"))
    held = ranged.join(wanted.select("k", "p").distinct(), ["k", "p"], "left_semi").withColumn("upto", running)
    found = held.join(wanted, ["k", "p"]).where((F.col("upto") - F.col("c") <= F.col("at")) & (F.col("at") < F.col("upto")))
    return found.groupBy("k", "q").agg(
        F.max(F.when(F.col("side") == 0, F.col("x"))).alias("lo"),
        F.max(F.when(F.col("side") == 1, F.col("x"))).alias("hi"), F.max("frac").alias("frac"))


def exact_quantiles_many(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns with one scan of ``df``; None for a column without values."""
    cols = list(cols)
    if not cols:
        return {}
    out: dict[str, list[float | None]] = {c: [None for _ in probs] for c in cols}
    for r in values_at_quantiles(df, cols, probs).collect():
        out[cols[r["k"]]][r["q"]] = r["lo"] + (r["hi"] - r["lo"]) * r["frac"]
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolated quantiles of one column (pandas' default)."""
    return exact_quantiles_many(df, [col], probs)[col]


def prefix_sums(df: DataFrame, order: str, cols: list[str], keys: list[str] | None = None,
                descending: bool = False, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``cols`` along ``order`` within ``keys``, without a
    single-task window. A null key is a group like any other; null values count as 0.

    Range-partition on ``(keys, order)`` and sort; a vectorised pass per partition
    computes the local running sums and emits them with the partition id; the
    per-(key, partition) totals — at most one row per partition and key — give each
    partition's offset, which is joined back.
    """
    from pyspark import TaskContext
    from pyspark.sql import types as T

    keys = list(keys or [])
    o = F.col(order).desc() if descending else F.col(order).asc()
    # no fixed count: AQE may merge small neighbouring ranges, which keeps their order
    ranged = df.repartitionByRange(*keys, o).sortWithinPartitions(*keys, o)
    out_fields = list(df.schema.fields) + [T.StructField("_p", T.IntegerType())] + [
        T.StructField(f"{c}_local", T.DoubleType()) for c in cols]
    schema = T.StructType(out_fields)

    def run(batches):
        pid = TaskContext.get().partitionId()
        last, carry = None, None  # the key that the previous batch ended with, and its sums
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            pdf = pdf.copy()
            begins = np.zeros(n, bool)
            begins[0] = True
            for k in keys:
                now, null = pdf[k].to_numpy(), pdf[k].isna().to_numpy()
                begins[1:] |= ~((now[1:] == now[:-1]) & ~null[1:] & ~null[:-1] | null[1:] & null[:-1])
            starts = np.flatnonzero(begins)
            lengths = np.diff(np.append(starts, n))
            first = [None if pdf[k].isna().iloc[0] else pdf[k].iloc[0] for k in keys]
            goes_on = carry is not None and first == last
            sums = []
            for i, c in enumerate(cols):
                v = pdf[c].to_numpy(dtype="float64", na_value=0.0)
                total = np.cumsum(v)
                local = total - np.repeat(total[starts] - v[starts], lengths)
                if goes_on:  # only the leading run can continue
                    local[:lengths[0]] += carry[i]
                pdf[f"{c}_local"] = local
                sums.append(float(local[-1]))
            last, carry = [None if pdf[k].isna().iloc[-1] else pdf[k].iloc[-1] for k in keys], sums
            pdf["_p"] = pid
            yield pdf[[f.name for f in out_fields]]

    local = checkpoint(ranged.mapInPandas(run, schema=schema))
    # the running sum at the end of a (key, partition) slice is the slice's plain sum
    totals = local.groupBy(*keys, "_p").agg(
        *[F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"{c}_tot") for c in cols])
    w = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_p").alias("_q"),
                         *[F.coalesce(F.sum(f"{c}_tot").over(w), F.lit(0.0)).alias(f"{c}_off") for c in cols])
    same = F.col("_p") == F.col("_q")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    res = local.join(offs, same, "left")
    return res.select(*df.columns, *[(F.col(f"{c}_local") + F.col(f"{c}_off")).alias(f"{c}{suffix}")
                                     for c in cols])
