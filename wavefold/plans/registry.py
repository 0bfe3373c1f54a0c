"""Registry of checkable plans: name → (Spark builder, DuckDB oracle SQL or None).

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the whole
test tables. Floating outputs are rounded to 6 decimals in both the Spark plan
and the oracle (sums of doubles differ in the last digits between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate plan {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their ``@register`` calls run."""
    import importlib
    for mod in PLAN_MODULES:
        importlib.import_module(f"{__package__}.{mod}")


PLAN_MODULES = ("q_groupstats", "q_reshape", "q_features", "q_folds", "q_report", "q_blend", "q_scenarios", "q_models", "q_io", "q_specs", "q_clean", "q_checks")
