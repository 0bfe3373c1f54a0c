"""Counterfactual scenario plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import scenarios as sc
from .fixtures import fixture, with_fixtures
from .registry import register

CAT_COLS = ["uid", "glob_hlth_03", "glob_hlth_12", "edu_gru_12", "bmi_12", "n_orders_03", "n_orders_12"]

CATALOGUE_SQL = """
src AS (SELECT uid, glob_hlth_03, glob_hlth_12, edu_gru_12, bmi_12, n_orders_03, n_orders_12 FROM f_features),
st AS (SELECT 'glob_hlth' AS feature_name, '_03' AS wave, glob_hlth_03 AS category FROM src
       UNION ALL SELECT 'glob_hlth', '_12', glob_hlth_12 FROM src
       UNION ALL SELECT 'edu_gru', '_12', edu_gru_12 FROM src
       UNION ALL SELECT 'bmi', '_12', CAST(bmi_12 AS VARCHAR) FROM src
       UNION ALL SELECT 'n_orders', '_03', CAST(n_orders_03 AS VARCHAR) FROM src
       UNION ALL SELECT 'n_orders', '_12', CAST(n_orders_12 AS VARCHAR) FROM src),
cat AS (SELECT feature_name, category,
               feature_name IN ('glob_hlth', 'n_orders') AS year_03, TRUE AS year_12,
               sum(CASE WHEN wave = '_03' THEN 1 ELSE 0 END) AS count_03,
               sum(CASE WHEN wave = '_12' THEN 1 ELSE 0 END) AS count_12,
               CAST(NULL AS BIGINT) AS count
        FROM st WHERE category IS NOT NULL GROUP BY feature_name, category)"""


def _catalogue(spark, sf_dir):
    return sc.catalogue(fixture(spark, sf_dir, "f_features").select(*CAT_COLS), "uid")


@register("category_catalogue", with_fixtures(f"""
WITH {CATALOGUE_SQL}
SELECT feature_name, category, year_03, year_12, CAST(count_03 AS BIGINT) AS count_03,
       CAST(count_12 AS BIGINT) AS count_12, count FROM cat""", "f_features"))
def category_catalogue(spark, sf_dir):
    return _catalogue(spark, sf_dir)


def _clean_sql(expr: str) -> str:
    return (f"replace(replace(replace(replace(replace(replace({expr}, ' ', '_'), '.', '_'), ',', '_'), "
            f"'/', '_'), '(', ''), ')', '')")


@register("scenario_override", with_fixtures(f"""
WITH {CATALOGUE_SQL},
keep AS (SELECT * FROM cat WHERE feature_name NOT IN ('age', 'hincome')
         AND greatest(count_03, count_12, coalesce(count, 0)) > 100)
SELECT f.uid,
  CASE WHEN k.feature_name = 'glob_hlth' AND k.year_03 AND f.glob_hlth_03 IS NOT NULL THEN k.category ELSE f.glob_hlth_03 END AS glob_hlth_03,
  CASE WHEN k.feature_name = 'glob_hlth' AND k.year_12 AND f.glob_hlth_12 IS NOT NULL THEN k.category ELSE f.glob_hlth_12 END AS glob_hlth_12,
  CASE WHEN k.feature_name = 'edu_gru' AND k.year_12 AND f.edu_gru_12 IS NOT NULL THEN k.category ELSE f.edu_gru_12 END AS edu_gru_12,
  CASE WHEN k.feature_name = 'bmi' AND k.year_12 AND f.bmi_12 IS NOT NULL THEN TRY_CAST(k.category AS INTEGER) ELSE f.bmi_12 END AS bmi_12,
  CASE WHEN k.feature_name = 'n_orders' AND k.year_03 AND f.n_orders_03 IS NOT NULL THEN TRY_CAST(k.category AS BIGINT) ELSE f.n_orders_03 END AS n_orders_03,
  CASE WHEN k.feature_name = 'n_orders' AND k.year_12 AND f.n_orders_12 IS NOT NULL THEN TRY_CAST(k.category AS BIGINT) ELSE f.n_orders_12 END AS n_orders_12,
  {_clean_sql("k.feature_name || '@' || k.category")} AS feature_category
FROM f_features f, keep k""", "f_features"))
def scenario_override(spark, sf_dir):
    """Every kept (feature, category) scenario applied to every row."""
    cat = sc.filter_catalogue(_catalogue(spark, sf_dir), ("age", "hincome"), 100)
    f = fixture(spark, sf_dir, "f_features").select(*CAT_COLS)
    return sc.override(f, sc.scenario_table(cat))


# a score that SQL can state, of every feature a scenario changes
@register("scenario_delta", with_fixtures(f"""
WITH {CATALOGUE_SQL},
keep AS (SELECT * FROM cat WHERE greatest(count_03, count_12) > 100),
r AS (SELECT l.year, f.* FROM f_labels l JOIN f_features f ON l.uid = f.uid),
x AS (SELECT {_clean_sql("k.feature_name || '@' || k.category")} AS feature_category, r.year,
  glob_hlth_03 AS h3, glob_hlth_12 AS h12, edu_gru_12 AS e12, bmi_12 AS b12, n_orders_03 AS n3, n_orders_12 AS n12,
  CASE WHEN k.feature_name = 'glob_hlth' AND r.glob_hlth_03 IS NOT NULL THEN k.category ELSE r.glob_hlth_03 END AS t3,
  CASE WHEN k.feature_name = 'glob_hlth' AND r.glob_hlth_12 IS NOT NULL THEN k.category ELSE r.glob_hlth_12 END AS t12,
  CASE WHEN k.feature_name = 'edu_gru' AND r.edu_gru_12 IS NOT NULL THEN k.category ELSE r.edu_gru_12 END AS u12,
  CASE WHEN k.feature_name = 'bmi' AND r.bmi_12 IS NOT NULL THEN TRY_CAST(k.category AS INTEGER) ELSE r.bmi_12 END AS c12,
  CASE WHEN k.feature_name = 'n_orders' AND r.n_orders_03 IS NOT NULL THEN TRY_CAST(k.category AS BIGINT) ELSE r.n_orders_03 END AS o3,
  CASE WHEN k.feature_name = 'n_orders' AND r.n_orders_12 IS NOT NULL THEN TRY_CAST(k.category AS BIGINT) ELSE r.n_orders_12 END AS o12
  FROM r, keep k)
SELECT feature_category, year, count(*) AS n,
  count(*) FILTER (h3 IS DISTINCT FROM t3 OR h12 IS DISTINCT FROM t12 OR e12 IS DISTINCT FROM u12 OR b12 IS DISTINCT FROM c12
                   OR n3 IS DISTINCT FROM o3 OR n12 IS DISTINCT FROM o12) AS n_scored,
  round(avg(CAST(7 * length(t3) + coalesce(length(t12), 0) * o12 + 3 * length(u12) - c12 + 5 * o3 AS DOUBLE)), 6) AS mean_predicted
FROM x GROUP BY feature_category, year""", "f_features", "f_labels"))
def scenario_delta(spark, sf_dir):
    """Means of every scenario by a stated score, of which only changed rows are computed."""
    table = sc.scenario_table(sc.filter_catalogue(_catalogue(spark, sf_dir), (), 100))
    rows = fixture(spark, sf_dir, "f_labels").select("uid", F.col("year").cast("int").alias("year")).join(
        fixture(spark, sf_dir, "f_features").select(*CAT_COLS), "uid")

    def score(x):
        return x.withColumn("prediction", (
            7 * F.length("glob_hlth_03") + F.coalesce(F.length("glob_hlth_12"), F.lit(0)) * F.col("n_orders_12")
            + 3 * F.length("edu_gru_12") - F.col("bmi_12") + 5 * F.col("n_orders_03")).cast("double"))

    return round_doubles(sc.delta_means(rows, sc.valid_table(rows, table), score))


@register("scenario_median_shift", with_fixtures("""
WITH m AS (SELECT quantile_cont(hincome_03, 0.5) AS m3, quantile_cont(hincome_12, 0.5) AS m12 FROM f_features)
SELECT uid, round(hincome_03 + m3, 6) AS hincome_03, round(hincome_12 + m12, 6) AS hincome_12,
       'hincome@add_median' AS feature_category
FROM f_features, m""", "f_features"))
def scenario_median_shift(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "hincome_03", "hincome_12")
    return round_doubles(sc.median_shift(f, ["hincome", "hinc_rent"]))
