"""Fold assignment (K4–K6).

Folds are a pure function of the key and a seed (md5), so any engine can
repeat them and no shuffle or driver round trip is needed. ``balanced=True``
gives KFold-like sizes (equal to ±1) through a distributed dense index.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import md5_bucket
from ..session import checkpoint
from .participation import dense_index


def kfold(df: DataFrame, keys: str | Sequence[str], k: int = 5, seed: int = 42,
          out: str = "fold", balanced: bool = False) -> DataFrame:
    """Fold 1..k per row from ``md5(keys|seed)`` (K4).

    ``balanced``: order rows by their hash, number them 0..n−1 with a
    distributed dense index and take ``idx % k + 1``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not balanced:
        return df.withColumn(out, md5_bucket(k, *keys, F.lit(seed)) + 1)
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in keys], F.lit(str(seed))))
    x = df.withColumn("_h", h)
    x = dense_index(x, ["_h", *keys], "_i")
    return x.withColumn(out, (F.col("_i") % k + 1).cast("int")).drop("_h", "_i")


def combined_fold(rows: DataFrame, key_folds: DataFrame, key: str = "uid", k: int = 5,
                  seed: int = 42, key_fold: str = "fold1", row_keys: Sequence[str] = ("uid", "year"),
                  out: str = "combined_fold") -> DataFrame:
    """``"{fold1}_{fold2}"``: key-level fold (0 when the key has none) × row-level fold (K5)."""
    x = rows.join(key_folds.select(key, key_fold), key, "left") \
        .withColumn(key_fold, F.coalesce(F.col(key_fold), F.lit(0)))
    x = x.withColumn("_fold2", md5_bucket(k, *row_keys, F.lit(seed)) + 1)
    return x.withColumn(out, F.concat_ws("_", F.col(key_fold).cast("string"),
                                         F.col("_fold2").cast("string"))).drop("_fold2")


def _rounds(loads: list[int], size: int, count: int) -> tuple[list[tuple[int, list[int]]], list[int]]:
    """How ``count`` groups of one size go to the lightest fold each, ties to the smaller fold.

    Fold f takes items when the level reaches its load, its load + size, and so
    on, so the items go round the folds that have been reached. Returns (first
    item, folds in turn) for each stretch with the same folds, and the new loads.
    """
    k, least = len(loads), min(loads)
    joins = [(load - least) // size for load in loads]  # the round in which a fold takes its first item
    order = sorted(range(k), key=lambda f: ((loads[f] - least) % size, f))
    stretches, loads = [], list(loads)
    for at in sorted(set(joins)):
        turn = [f for f in order if joins[f] <= at]
        first = sum(at - joins[f] for f in turn)
        if first >= count:
            break
        stretches.append((first, turn))
    for (first, turn), after in zip(stretches, [f for f, _ in stretches[1:]] + [count]):
        whole, rest = divmod(after - first, len(turn))
        for i, f in enumerate(turn):
            loads[f] += size * (whole + (i < rest))
    return stretches, loads


def group_kfold(df: DataFrame, group: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Whole groups per fold, balanced greedily by size (K6, GroupKFold).

    The largest group goes to the currently lightest fold (ties: smaller fold id;
    equal sizes in the order of the group as a string, a null group, which is a
    group like any other, first). Groups of one size go round the folds in a fixed
    turn, so the driver sees one row per distinct size (their number is below the
    root of twice the rows), and the groups get their place among those of their
    size, and their fold, in the cluster.
    """
    sizes = df.groupBy(group).count().select(F.col(group).alias("_g"), F.col("count").alias("_size"))
    placed = dense_index(sizes.withColumn("_less", -F.col("_size")).withColumn("_name", F.col("_g").cast("string")),
                         ["_less", "_name"], "_i")
    placed = checkpoint(placed.select("_g", "_size", "_i"))
    loads, begin, table = [0] * k, 0, []
    for r in placed.groupBy("_size").count().orderBy(F.col("_size").desc()).collect():
        stretches, loads = _rounds(loads, r["_size"], r["count"])
        ends = [f for f, _ in stretches[1:]] + [r["count"]]
        table += [(r["_size"], begin + f, begin + e, [x + 1 for x in turn]) for (f, turn), e in zip(stretches, ends)]
        begin += r["count"]
    turns = df.sparkSession.createDataFrame(table, "_of long, _from long, _to long, _turn array<int>")
    fold = F.get("_turn", F.pmod(F.col("_i") - F.col("_from"), F.size("_turn")).cast("int"))
    folds = placed.join(turns, (F.col("_size") == F.col("_of")) & (F.col("_i") >= F.col("_from")) & (F.col("_i") < F.col("_to"))
                        ).select("_g", fold.alias(out))
    return df.join(folds, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
