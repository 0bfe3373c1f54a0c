"""Participation patterns and dense codes.

A participation pattern is the sorted list of years a key was seen in (waves
of the long feature table plus label years), written as ``[2003, 2012, 2016]``.
The vocabulary of patterns is fitted on train (sorted distinct strings → 1..k)
and applied to test; an unseen pattern gets NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .reshape import OneHot


def year_patterns(long: DataFrame, labels: DataFrame, key: str = "uid", year: str = "year") -> DataFrame:
    """``(key, n_years, years array<int>, pattern string)`` per key.

    Every occurrence counts (a wave and a label in the same year give the year
    twice), as in the reference's concatenation of both tables.
    """
    # Joined, not united: Spark (4.1) takes a union of two tables split alike for one that is split so too and may then
    # merge the two sides' partitions differently while it runs; a join above fails ("Can't zip RDDs") or keys are listed twice.
    # One row per key and year before years are listed, so a key with many rows is folded on the map side.
    a, b = (t.select(F.col(key).alias("_k"), F.col(year).cast("int").alias("_y")).groupBy("_k", "_y").agg(
        F.count(F.lit(1)).alias("_c")).alias(name) for t, name in ((long, "a"), (labels, "b")))
    met = a.join(b, F.col("a._k").eqNullSafe(F.col("b._k")) & F.col("a._y").eqNullSafe(F.col("b._y")), "full")
    per_year = met.select(F.coalesce("a._k", "b._k").alias(key), F.coalesce("a._y", "b._y").alias(year),
                          (F.coalesce("a._c", F.lit(0)) + F.coalesce("b._c", F.lit(0))).alias("_n"))
    listed = F.array_sort(F.collect_list(F.when(F.col(year).isNotNull(), F.struct(F.col(year).alias("y"), F.col("_n").alias("n")))))
    g = per_year.groupBy(key).agg(
        F.coalesce(F.sum(F.when(F.col(year).isNotNull(), F.col("_n"))), F.lit(0)).alias("n_years"),
        F.flatten(F.transform(listed, lambda s: F.array_repeat(s["y"], s["n"].cast("int")))).alias("years"))
    return g.withColumn("pattern", F.concat(F.lit("["), F.array_join(F.col("years"), ", "), F.lit("]")))


@dataclass
class PatternVocab:
    table: DataFrame  # (pattern, year_participation)

    def apply(self, patterns: DataFrame, key: str = "uid") -> DataFrame:
        """``(key, year_participation)``; unseen patterns → NULL (K2)."""
        return patterns.join(self.table, "pattern", "left").select(key, "year_participation")


def fit_pattern_vocab(patterns: DataFrame) -> PatternVocab:
    """Sorted distinct patterns → 1..k.

    The distinct patterns are numbered by a distributed index, so their number is
    free to grow.
    """
    ranked = dense_index(patterns.select("pattern").distinct(), ["pattern"], "_i")
    return PatternVocab(ranked.select("pattern", (F.col("_i") + 1).cast("int").alias("year_participation")))


def participation_codes(train_long: DataFrame, train_labels: DataFrame,
                        test_long: DataFrame | None = None, test_keys: DataFrame | None = None,
                        key: str = "uid") -> DataFrame:
    """Codes for train and (optionally) test keys with the train vocabulary (K1–K3)."""
    tr = year_patterns(train_long, train_labels, key)
    vocab = fit_pattern_vocab(tr)
    out = vocab.apply(tr, key)
    if test_long is not None:
        te = year_patterns(test_long, test_keys, key)
        out = out.unionByName(vocab.apply(te, key))
    return out


def participation_onehot(codes: DataFrame, k: int) -> DataFrame:
    """One-hot of the code (no null flag), keeping the code itself (K3, R8); ``k`` is the
    size of the fitted vocabulary (see `vocab_size`)."""
    oh = OneHot({"year_participation": list(range(1, k + 1))}, null_flag=False)
    return oh.apply(codes, drop_source=False)


def vocab_size(vocab: PatternVocab) -> int:
    return vocab.table.agg(F.max("year_participation")).first()[0] or 0


def dense_index(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """0..n−1 index following ``order`` without a single-partition window.

    Range-partition and sort, checkpoint (fixes the sampled bounds), count rows
    per partition (one small row per partition), and add each partition's
    offset to the row's position inside it.
    """
    # no fixed count: AQE may merge small neighbouring ranges, which keeps their order
    r = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .withColumn("_p", F.spark_partition_id())
         .withColumn("_m", F.monotonically_increasing_id()))
    r = checkpoint(r)
    sizes = r.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    offs = sizes.select("_p", "_m0", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_off"))
    # ``offs`` has one row per partition: bounded by the partition count.
    return r.join(F.broadcast(offs), "_p").select(
        *df.columns, (F.col("_off") + F.col("_m") - F.col("_m0")).alias(name)).drop("_p", "_m")


def dense_codes(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` → 0..k−1 codes, joined back."""
    name = name or f"{col}_num"
    codes = dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), [col], name)
    return df.join(codes, col, "left")
