"""Column and row cleaning operators.

Everything here is a projection or a filter expressed with built-in
expressions, so Catalyst prunes columns and pushes filters into the scan.
Statistics needed by a transform (quantiles, fill values) are computed once,
by one aggregation, and returned as a small fitted object that can be applied
to other frames (train → test).
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import reduce
from itertools import chain
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles_many


# ----------------------------------------------------------------- projections

def select_regex(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose name matches ``pattern`` (``re.search``, P1)."""
    rx = re.compile(pattern)
    return df.select(*[c for c in df.columns if rx.search(c)])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Remove a name suffix."""
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in df.columns
                                  if c.endswith(suffix) and len(c) > len(suffix)})


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring names that do not exist (P5)."""
    return df.drop(*[c for c in cols if c in df.columns])


def align_schema(df: DataFrame, columns: Sequence[str], fill=0,
                 types: Mapping[str, str] | None = None) -> DataFrame:
    """Select ``columns`` in order; missing ones become the literal ``fill``."""
    types = types or {}
    out = []
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        else:
            lit = F.lit(fill)
            out.append((lit.cast(types[c]) if c in types else lit).alias(c))
    return df.select(*out)


def sample_columns(df: DataFrame, fraction: float, keep: Sequence[str] = (),
                   seed: int = 42) -> DataFrame:
    """Drop ``int(n·fraction)`` of the droppable columns, chosen by a seeded hash.

    Metadata only: names are ordered by ``md5(name|seed)`` on the driver and the
    first ones are dropped; no data pass.
    """
    droppable = [c for c in df.columns if c not in set(keep)]
    n_drop = int(len(droppable) * fraction)
    ranked = sorted(droppable, key=lambda c: hashlib.md5(f"{c}|{seed}".encode()).hexdigest())
    return df.drop(*ranked[:n_drop])


def columns_by_type(df: DataFrame, kinds: Sequence[str]) -> list[str]:
    """Names whose simple type string is one of ``kinds``."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in set(kinds)]


def columns_excluding(df: DataFrame, substrings: Sequence[str]) -> list[str]:
    """Names that contain none of ``substrings``."""
    return [c for c in df.columns if not any(s in c for s in substrings)]


def columns_with_prefix(df: DataFrame, prefix: str, not_suffix: str | None = None) -> list[str]:
    """Names starting with ``prefix`` and not ending with ``not_suffix`` (P10)."""
    return [c for c in df.columns if c.startswith(prefix)
            and not (not_suffix and c.endswith(not_suffix))]


def schema_difference(spark, a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of ``a`` missing from ``b`` and vice versa, as a small table."""
    rows = [(c, "missing_in_right") for c in a.columns if c not in b.columns] + \
           [(c, "missing_in_left") for c in b.columns if c not in a.columns]
    return spark.createDataFrame(rows, "column string, side string")


def dedupe_column_names(names: Sequence[str]) -> list[int]:
    """Indices of the first occurrence of each name."""
    seen, keep = set(), []
    for i, n in enumerate(names):
        if n not in seen:
            seen.add(n)
            keep.append(i)
    return keep


# ---------------------------------------------------------------------- filters

def null_count(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b,
                  [F.when(F.col(c).isNull(), 1).otherwise(0) for c in cols], F.lit(0))


def drop_sparse_rows(df: DataFrame, first_wave: Sequence[str], second_wave: Sequence[str],
                     first_all_null: int | None = 75, second_min_null: int | None = 100) -> DataFrame:
    """Keep rows with few nulls in both waves.

    Per wave the row is kept if ``nulls < int((width + 1) / 2)`` (the reference
    counts its helper column in the width), or — first wave — if ``nulls`` equals
    ``first_all_null``, or — second wave — if ``nulls > second_min_null``.
    """
    n1, n2 = null_count(first_wave), null_count(second_wave)
    keep1 = n1 < F.lit(int((len(first_wave) + 1) / 2))
    if first_all_null is not None:
        keep1 = keep1 | (n1 == first_all_null)
    keep2 = n2 < F.lit(int((len(second_wave) + 1) / 2))
    if second_min_null is not None:
        keep2 = keep2 | (n2 > second_min_null)
    return df.where(keep1 & keep2)


def drop_any_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without a null in any of ``cols`` that exist."""
    return df.dropna("any", subset=[c for c in cols if c in df.columns])


def complete_pairs(labels: DataFrame, key: str = "uid", n: int = 2) -> DataFrame:
    """Keys with exactly ``n`` label rows."""
    return labels.groupBy(key).count().where(F.col("count") == n).select(key)


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str] = "uid") -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``."""
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str] = "uid") -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``."""
    return df.join(keys, on, "left_anti")


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic ``drop_duplicates(subset=key)`` keeping the first row by ``order``.

    Spelled as ``min_by`` over a struct of the order columns: a partial
    aggregation, so even a hot key is pre-reduced map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest]).alias("_row")
    order_key = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(*keys).agg(F.min_by(packed, order_key).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]))


def filter_contains_any(df: DataFrame, col: str, substrings: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` contains any of ``substrings`` (F8)."""
    cond = reduce(lambda a, b: a | b, [F.col(col).contains(s) for s in substrings], F.lit(False))
    return df.where(cond)


# ---------------------------------------------------------------- value recodes

def _map_expr(mapping: Mapping) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def ordinal_encode(df: DataFrame, orders: Mapping[str, Sequence[str]]) -> DataFrame:
    """Label → 1..k code, unknown → NULL; absent columns are skipped."""
    exprs = {c: _map_expr({lab: i + 1 for i, lab in enumerate(labels)})[F.col(c)].cast("int")
             for c, labels in orders.items() if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def recode_bands(df: DataFrame, bands: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Band label → number; unmatched values are kept when numeric.

    pandas ``replace`` keeps unmatched strings in an object column; a typed
    column cannot, so unmatched non-numeric strings become NULL.
    """
    exprs = {c: F.coalesce(_map_expr({k: float(v) for k, v in m.items()})[F.col(c)],
                           F.col(c).try_cast("double"))
             for c, m in bands.items() if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def lookup(df: DataFrame, col: str, mapping: Mapping, keep_unmatched: bool, out: str | None = None) -> DataFrame:
    """Dictionary lookup (J8): ``map`` (unmatched → NULL) or ``replace`` (unmatched kept)."""
    m = _map_expr(mapping)[F.col(col)]
    return df.withColumn(out or col, F.coalesce(m, F.col(col)) if keep_unmatched else m)


def narrow_age(df: DataFrame, first: str, second: str, ranges: Mapping[str, tuple[float, float]],
               gap: float = 9.0, out_first: str = "narrowed_age_03",
               out_second: str = "narrowed_age_12") -> DataFrame:
    """Narrow an age from two bands.

    Same band → the band's low end; changed band → mean of the first band's high
    end and the second band's low end; missing or unknown band → NULL. The
    second-wave age is the first plus ``gap``.
    """
    lo = _map_expr({k: float(v[0]) for k, v in ranges.items()})
    hi = _map_expr({k: float(v[1]) for k, v in ranges.items()})
    a, b = F.col(first), F.col(second)
    age = (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
           .when(a == b, lo[a])
           .otherwise((hi[a] + lo[b]) / 2))
    return df.withColumn(out_first, age).withColumn(out_second, F.col(out_first) + gap)


@dataclass
class Caps:
    """Fitted per-column caps (winsorizing)."""
    values: dict[str, float] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        exprs = {c: F.when(F.col(c) > v, F.lit(v)).otherwise(F.col(c))
                 for c, v in self.values.items() if c in df.columns and v is not None}
        return df.withColumns(exprs) if exprs else df


def fit_caps(df: DataFrame, cols: Sequence[str], q: float = 0.99) -> Caps:
    """Exact per-column ``q`` quantile over non-null values."""
    cols = [c for c in cols if c in df.columns]
    return Caps({c: v[0] for c, v in exact_quantiles_many(df, cols, [q]).items()})


def winsorize(df: DataFrame, cols: Sequence[str], q: float = 0.99) -> DataFrame:
    """Replace values above the column's ``q`` quantile by that quantile; NULL kept."""
    return fit_caps(df, cols, q).apply(df)


def fit_fill_quantile(df: DataFrame, cols: Sequence[str], q: float) -> dict[str, float]:
    """Per-column quantile fill values computed on ``df`` in one pass."""
    return {c: v[0] for c, v in exact_quantiles_many(df, [c for c in cols if c in df.columns], [q]).items()}


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``na.fill`` with a dict, skipping absent columns and NULL fill values."""
    vals = {c: v for c, v in values.items() if c in df.columns and v is not None}
    return df.na.fill(vals) if vals else df
