"""Blend and final-score plans (M10, M11, X9–X11, X18) on given predictions.

Train rows are seed 0 and test rows seed 1 of the prediction stand-in; the
blend category is the row's group (``missing`` when NULL).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import blend as bl
from .fixtures import fixture, with_fixtures
from .registry import register


def _cat(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    g = fixture(spark, sf_dir, "f_labels_nullkey").select(
        "uid", "year", F.coalesce("grp", F.lit("missing")).alias("category"))
    return p.join(g, ["uid", "year"], "left")


CAT_SQL = """pc AS (SELECT p.*, coalesce(g.grp, 'missing') AS category FROM f_predictions p
                   LEFT JOIN f_labels_nullkey g ON p.uid = g.uid AND p.year = g.year)"""
WEIGHTS_SQL = """
r AS (SELECT category, model, sqrt(avg((predicted_score - composite_score) ^ 2)) AS rmse
      FROM pc WHERE seed = 0 GROUP BY category, model),
r2 AS (SELECT *, exp(-rmse - max(-rmse) OVER (PARTITION BY category)) AS e FROM r),
w AS (SELECT category, model, rmse, e / sum(e) OVER (PARTITION BY category) AS weight FROM r2)"""


@register("softmax_weights", with_fixtures(f"""
WITH {CAT_SQL}, {WEIGHTS_SQL}
SELECT category, model, round(rmse, 6) AS rmse, round(weight, 6) AS weight FROM w""",
                                           "f_predictions", "f_labels_nullkey"))
def softmax_weights(spark, sf_dir):
    pc = _cat(spark, sf_dir)
    return round_doubles(bl.group_rmse_weights(pc.where(F.col("seed") == 0)))


@register("softmax_temperature", with_fixtures(f"""
WITH {CAT_SQL},
r AS (SELECT category, sqrt(avg((predicted_score - composite_score) ^ 2)) AS rmse
      FROM pc WHERE seed = 0 AND model = 'm_c' GROUP BY category),
r2 AS (SELECT *, 'm_c' AS model, exp((rmse - max(rmse) OVER ()) / 10) AS e FROM r)
SELECT category, model, round(rmse, 6) AS rmse, round(e / sum(e) OVER (), 6) AS weight FROM r2""", "f_predictions", "f_labels_nullkey"))
def softmax_temperature(spark, sf_dir):
    """Report weights: softmax(+RMSE / 10) over the groups of one model (Q13, M12 inputs)."""
    pc = _cat(spark, sf_dir).where((F.col("seed") == 0) & (F.col("model") == "m_c"))
    return round_doubles(bl.group_rmse_weights(pc, "model", "category", temperature=10.0, sign=1.0)
                         .select("category", "model", "rmse", "weight"))


@register("softmax_blend", with_fixtures(f"""
WITH {CAT_SQL}, {WEIGHTS_SQL}
SELECT pc.uid, pc.year, pc.category, round(coalesce(sum(w.weight * pc.predicted_score), 0), 6) AS blended_score
FROM pc LEFT JOIN w ON pc.category = w.category AND pc.model = w.model
WHERE pc.seed = 1 GROUP BY pc.uid, pc.year, pc.category""", "f_predictions", "f_labels_nullkey"))
def softmax_blend(spark, sf_dir):
    pc = _cat(spark, sf_dir)
    w = bl.group_rmse_weights(pc.where(F.col("seed") == 0))
    return round_doubles(bl.blend(pc.where(F.col("seed") == 1), w))


@register("directed_rounding", with_fixtures("""
SELECT uid, year, model, seed,
       CAST(CASE WHEN predicted_score > 1000 THEN floor(predicted_score) ELSE ceil(predicted_score) END AS DOUBLE)
         AS rounded_score
FROM f_predictions""", "f_predictions"))
def directed_rounding(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    return p.select("uid", "year", "model", "seed", bl.directed_round("predicted_score").alias("rounded_score"))


@register("seed_average_final", with_fixtures(f"""
WITH {CAT_SQL}, {WEIGHTS_SQL},
bs AS (SELECT pc.uid, pc.year, pc.seed, coalesce(sum(w.weight * pc.predicted_score), 0) AS blended_score
       FROM pc LEFT JOIN w ON pc.category = w.category AND pc.model = w.model
       GROUP BY pc.uid, pc.year, pc.seed)
SELECT uid, year, CAST(ceil(avg(blended_score)) AS DOUBLE) AS composite_score FROM bs GROUP BY uid, year""",
                                              "f_predictions", "f_labels_nullkey"))
def seed_average_final(spark, sf_dir):
    pc = _cat(spark, sf_dir)
    w = bl.group_rmse_weights(pc.where(F.col("seed") == 0))
    blended = bl.blend(pc, w, keys=("uid", "year", "seed"))
    return bl.finalize(blended, ("uid", "year"), "blended_score")
