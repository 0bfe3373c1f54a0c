"""Small scalar column helpers (all JVM-side built-in expressions)."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double / float column (presentation for cross-engine checks)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Ingest rule: NaN never travels inside; it becomes NULL.

    Spark orders NaN above every number (``NaN > 5`` is true) and ``max``/``avg``
    over NaN are NaN, unlike pandas, which skips NaN like a missing value.
    """
    names = set(cols or [f.name for f in df.schema.fields
                         if isinstance(f.dataType, (T.DoubleType, T.FloatType))])
    return df.select(*[
        F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if c in names else F.col(c)
        for c in df.columns
    ])


def positive_log(c: str | Column) -> Column:
    """``ln x`` for ``x > 0``, else NULL."""
    x = col_or(c)
    return F.when(x > 0, F.log(x))


def directed_round(c: str | Column, limit: float = 1000.0) -> Column:
    """Floor above ``limit``, ceil otherwise (X9); result double."""
    x = col_or(c)
    return F.when(x > limit, F.floor(x)).otherwise(F.ceil(x)).cast("double")


def md5_unit(*parts: str | Column) -> Column:
    """Deterministic uniform number in [0, 1) from an md5 of the parts joined by ``|``.

    Uses the first 8 hex digits (32 bits); DuckDB repeats it exactly with
    ``md5`` + hex parsing, which makes hash-based folds and bootstrap weights
    checkable.
    """
    s = F.concat_ws("|", *[col_or(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def md5_bucket(k: int, *parts: str | Column) -> Column:
    """``0 … k−1`` from the md5 of the parts (hash fold)."""
    s = F.concat_ws("|", *[col_or(p).cast("string") for p in parts])
    return F.pmod(F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint"), F.lit(k)).cast("int")


_NON_WORD = re.compile(r"[^\w]")


def sanitize_name(name: str) -> str:
    """Replace every non-word character by ``_``."""
    return _NON_WORD.sub("_", name)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename columns with :func:`sanitize_name`; raise if two names collide."""
    new = [sanitize_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"sanitized column names collide: {dup}")
    return df.toDF(*new)
