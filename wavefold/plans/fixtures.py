"""Survey-shaped stand-ins derived from the driver's test tables.

The reference reads survey CSVs that are not shipped; these views give the
operators the same shapes (labels per ``(uid, year)``, wide waves per ``uid``,
long predictions, long ordered scores) from ``orders``, ``customer`` and
``lineitem``. Every view is computed by Spark from the whole tables, so its
size grows with the scale factor.

``FIXTURE_SQL`` holds the same definitions as DuckDB-runnable SQL; the oracle
statements in ``__spark_entry__`` prefix them as CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _before(c: str, year: int) -> Column:
    """``c`` lies before a year, as a timestamp range Parquet can prune on
    (a predicate on ``year(c)`` is not pushed into the scan)."""
    return F.col(c) < F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(uid bigint, year int, composite_score double)``: orders of 1999 and 2000 → 2016, later ones → 2021."""
    o = table(spark, sf_dir, "orders")
    return (
        o.where(~_before("o_orderdate", 1999))
        .groupBy(F.col("o_custkey").alias("uid"),
                 F.when(_before("o_orderdate", 2001), F.lit(2016)).otherwise(F.lit(2021)).alias("year"))
        .agg(F.avg("o_totalprice").alias("avg_price"))
        .select("uid", "year", F.floor(F.col("avg_price") / 250).cast("double").alias("composite_score"))
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide waves per customer: orders up to 1996 stand for ``_03``, those of 1997 and 1998 for ``_12``."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
        .where(_before("o_orderdate", 1999))
    )
    w03 = _before("o_orderdate", 1997)
    # Pre-aggregate orders per customer before the join (map-side combine),
    # so the join sees one row per customer instead of one per order.
    per_cust = o.groupBy("o_custkey").agg(
        F.min(F.when(w03, F.col("o_orderpriority"))).alias("glob_hlth_03"),
        F.min(F.when(~w03, F.col("o_orderpriority"))).alias("glob_hlth_12"),
        F.max(F.when(w03, F.col("o_totalprice"))).alias("hincome_03"),
        F.max(F.when(~w03, F.col("o_totalprice"))).alias("hincome_12"),
        F.count(F.when(w03, F.lit(1))).alias("n_orders_03"),
        F.count(F.when(~w03, F.lit(1))).alias("n_orders_12"),
    )
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    return j.select(
        F.col("c_custkey").alias("uid"),
        F.col("c_mktsegment").alias("edu_gru_12"),
        F.col("c_nationkey").alias("bmi_12"),
        "glob_hlth_03", "glob_hlth_12", "hincome_03", "hincome_12",
        F.coalesce("n_orders_03", F.lit(0)).alias("n_orders_03"),
        F.coalesce("n_orders_12", F.lit(0)).alias("n_orders_12"),
    )


# Fixed values of the prediction stand-in: three formula models, two seeds.
PRED_MODELS = (("m_a", 1), ("m_b", 2), ("m_c", 3))
PRED_SEEDS = (0, 1)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long predictions ``(uid, year, model, seed, composite_score, predicted_score)``.

    The 3 × 2 expansion is a generator over a literal array, not a join.
    """
    lab = labels(spark, sf_dir)
    combos = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(k).alias("k"), F.lit(s).alias("seed"))
        for m, k in PRED_MODELS for s in PRED_SEEDS
    ])
    x = lab.select("*", F.explode(combos).alias("mk")).select(
        "uid", "year", "mk.model", "mk.seed", "composite_score", "mk.k")
    noise = ((F.col("uid") * 7 + F.col("k") * 13 + F.col("seed") * 5 + F.col("year")) % 101 - 50) * F.col("k")
    return x.select(
        "uid", "year", "model", "seed", "composite_score",
        (F.col("composite_score") + noise.cast("double") / 2).alias("predicted_score"),
    )


def long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("g1"),
        F.col("l_linestatus").alias("g2"),
        F.col("l_orderkey").alias("uid"),
        F.col("l_linenumber").alias("line"),
        F.floor("l_quantity").cast("double").alias("composite_score"),
    )


def labels_nullkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = labels(spark, sf_dir)
    f = features(spark, sf_dir).select("uid", F.col("glob_hlth_03").alias("grp"))
    return lab.join(f, "uid", "left").select("uid", "year", "composite_score", "grp")


FIXTURE_SQL = {
    "f_labels": """
SELECT o_custkey AS uid,
       CASE WHEN year(o_orderdate) < 2001 THEN 2016 ELSE 2021 END AS year,
       CAST(floor(avg(o_totalprice) / 250) AS DOUBLE) AS composite_score
FROM orders WHERE year(o_orderdate) >= 1999
GROUP BY o_custkey, CASE WHEN year(o_orderdate) < 2001 THEN 2016 ELSE 2021 END""",
    "f_features": """
SELECT c.c_custkey AS uid, c.c_mktsegment AS edu_gru_12, c.c_nationkey AS bmi_12,
       min(CASE WHEN year(o.o_orderdate) < 1997 THEN o.o_orderpriority END) AS glob_hlth_03,
       min(CASE WHEN year(o.o_orderdate) IN (1997, 1998) THEN o.o_orderpriority END) AS glob_hlth_12,
       max(CASE WHEN year(o.o_orderdate) < 1997 THEN o.o_totalprice END) AS hincome_03,
       max(CASE WHEN year(o.o_orderdate) IN (1997, 1998) THEN o.o_totalprice END) AS hincome_12,
       count(CASE WHEN year(o.o_orderdate) < 1997 THEN 1 END) AS n_orders_03,
       count(CASE WHEN year(o.o_orderdate) IN (1997, 1998) THEN 1 END) AS n_orders_12
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_mktsegment, c.c_nationkey""",
    "f_predictions": """
SELECT l.uid, l.year, m.model, s.seed, l.composite_score,
       l.composite_score + CAST(((l.uid * 7 + m.k * 13 + s.seed * 5 + l.year) % 101 - 50) * m.k AS DOUBLE) / 2 AS predicted_score
FROM f_labels l
CROSS JOIN (SELECT 'm_a' AS model, 1 AS k UNION ALL SELECT 'm_b', 2 UNION ALL SELECT 'm_c', 3) m
CROSS JOIN (SELECT 0 AS seed UNION ALL SELECT 1) s""",
    "f_long_scores": """
SELECT l_returnflag AS g1, l_linestatus AS g2, l_orderkey AS uid, l_linenumber AS line,
       CAST(floor(l_quantity) AS DOUBLE) AS composite_score
FROM lineitem""",
    "f_labels_nullkey": """
SELECT l.uid, l.year, l.composite_score, f.glob_hlth_03 AS grp
FROM f_labels l LEFT JOIN f_features f ON l.uid = f.uid""",
}

_FIXTURE_ORDER = ("f_labels", "f_features", "f_predictions", "f_long_scores", "f_labels_nullkey")
_FIXTURE_DEPS = {"f_predictions": ("f_labels",), "f_labels_nullkey": ("f_labels", "f_features")}


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs for the named fixtures (and their inputs)."""
    need: set[str] = set()
    for n in names:
        need.add(n)
        need.update(_FIXTURE_DEPS.get(n, ()))
    ctes = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in _FIXTURE_ORDER if n in need]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return {
        "f_labels": labels,
        "f_features": features,
        "f_predictions": predictions,
        "f_long_scores": long_scores,
        "f_labels_nullkey": labels_nullkey,
    }[name](spark, sf_dir)
