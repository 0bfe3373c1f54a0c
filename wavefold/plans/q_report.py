"""Report plans (A1–A9, A26–A29, G2–G13) over the long prediction stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import folds as fo
from ..operators import report as rp
from ..operators.features import qcut
from .fixtures import fixture, with_fixtures
from .q_folds import _md5_bucket_sql
from .registry import register

# Fixed value: the number of bootstrap replicates of the reference's report.
N_BOOT = 1000


def _preds_with_group(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    g = fixture(spark, sf_dir, "f_labels_nullkey").select("uid", "year", "grp")
    return p.join(g, ["uid", "year"], "left")


@register("rmse_by_group", with_fixtures("""
SELECT model, round(sqrt(avg((predicted_score - composite_score) ^ 2)), 6) AS rmse, count(*) AS num_samples
FROM f_predictions GROUP BY model""", "f_predictions"))
def rmse_by_group(spark, sf_dir):
    return round_doubles(rp.rmse(fixture(spark, sf_dir, "f_predictions"), ["model"]))


@register("rmse_global", with_fixtures("""
SELECT round(sqrt(avg((predicted_score - composite_score) ^ 2)), 6) AS rmse, count(*) AS num_samples
FROM f_predictions""", "f_predictions"))
def rmse_global(spark, sf_dir):
    return round_doubles(rp.rmse(fixture(spark, sf_dir, "f_predictions")))


@register("mae", with_fixtures("""
SELECT model, year, round(avg(abs(predicted_score - composite_score)), 6) AS mae, count(*) AS num_samples
FROM f_predictions GROUP BY model, year""", "f_predictions"))
def mae(spark, sf_dir):
    return round_doubles(rp.mae(fixture(spark, sf_dir, "f_predictions"), ["model", "year"]))


@register("rmse_spec_model_pivot", with_fixtures("""
SELECT model,
       round(sqrt(avg(CASE WHEN seed = 0 THEN (predicted_score - composite_score) ^ 2 END)), 6) AS seed_0,
       round(sqrt(avg(CASE WHEN seed = 1 THEN (predicted_score - composite_score) ^ 2 END)), 6) AS seed_1
FROM f_predictions GROUP BY model""", "f_predictions"))
def rmse_spec_model_pivot(spark, sf_dir):
    t = rp.pivot_rmse(fixture(spark, sf_dir, "f_predictions"), "model", "seed", [0, 1])
    return round_doubles(t.withColumnsRenamed({"0": "seed_0", "1": "seed_1"}))


@register("rmse_by_quintile", with_fixtures("""
WITH e AS (SELECT quantile_cont(composite_score, 0.0) AS e0, quantile_cont(composite_score, 0.2) AS e1,
                  quantile_cont(composite_score, 0.4) AS e2, quantile_cont(composite_score, 0.6) AS e3,
                  quantile_cont(composite_score, 0.8) AS e4, quantile_cont(composite_score, 1.0) AS e5
           FROM f_predictions),
b AS (SELECT p.*, CAST(CASE WHEN composite_score < e0 OR composite_score > e5 THEN NULL
                  WHEN composite_score <= e1 THEN 0 WHEN composite_score <= e2 THEN 1
                  WHEN composite_score <= e3 THEN 2 WHEN composite_score <= e4 THEN 3
                  WHEN composite_score <= e5 THEN 4 END AS INTEGER) AS bucket FROM f_predictions p, e)
SELECT bucket, model, round(sqrt(avg((predicted_score - composite_score) ^ 2)), 6) AS rmse, count(*) AS num_samples
FROM b GROUP BY bucket, model""", "f_predictions"))
def rmse_by_quintile(spark, sf_dir):
    p = qcut(fixture(spark, sf_dir, "f_predictions"), "composite_score", 5, out="bucket")
    return round_doubles(rp.rmse(p, ["bucket", "model"]))


GROUP_COLS = ["grp", "year"]

RMSE_GROUPS_SQL = """
st AS (SELECT 'grp' AS group_var, grp AS "group", model, predicted_score, composite_score FROM pg
       UNION ALL
       SELECT 'year', CAST(year AS VARCHAR), model, predicted_score, composite_score FROM pg),
rg AS (SELECT group_var, "group", model, sqrt(avg((predicted_score - composite_score) ^ 2)) AS rmse,
              count(*) AS num_samples FROM st GROUP BY group_var, "group", model)"""

PG_SQL = """pg AS (SELECT p.*, g.grp FROM f_predictions p LEFT JOIN f_labels_nullkey g
                  ON p.uid = g.uid AND p.year = g.year)"""


@register("rmse_subgroups", with_fixtures(f"""
WITH {PG_SQL}, {RMSE_GROUPS_SQL}
SELECT group_var, "group", model, round(rmse, 6) AS rmse, num_samples FROM rg""",
                                          "f_predictions", "f_labels_nullkey"))
def rmse_subgroups(spark, sf_dir):
    return round_doubles(rp.rmse_by_groups(_preds_with_group(spark, sf_dir), GROUP_COLS, ["model"]))


@register("fairness", with_fixtures(f"""
WITH {PG_SQL}, {RMSE_GROUPS_SQL}
SELECT group_var, model, round(1 - (max(rmse) - min(rmse)) / max(rmse), 6) AS fairness
FROM rg WHERE "group" IS NOT NULL GROUP BY group_var, model""", "f_predictions", "f_labels_nullkey"))
def fairness(spark, sf_dir):
    t = rp.rmse_by_groups(_preds_with_group(spark, sf_dir), GROUP_COLS, ["model"])
    return round_doubles(rp.fairness(t, ["group_var", "model"], null_groups=False))


def _with_combined_fold(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    pairs = lab.groupBy("uid").count().where(F.col("count") == 2).select("uid")
    f1 = fo.kfold(pairs, "uid", 5, 42, out="fold1")
    return fo.combined_fold(p, f1, "uid", 5, 42)


@register("fold_stability", with_fixtures(f"""
WITH pairs AS (SELECT uid FROM f_labels GROUP BY uid HAVING count(*) = 2),
f1 AS (SELECT uid, {_md5_bucket_sql(5, 'uid', '42')} AS fold1 FROM pairs),
p AS (SELECT p.*, CAST(coalesce(f1.fold1, 0) AS VARCHAR) || '_' ||
             CAST({_md5_bucket_sql(5, 'p.uid', 'p.year', '42')} AS VARCHAR) AS combined_fold
      FROM f_predictions p LEFT JOIN f1 ON p.uid = f1.uid),
r AS (SELECT model, seed, combined_fold, sqrt(avg((predicted_score - composite_score) ^ 2)) AS rmse FROM p
      GROUP BY model, seed, combined_fold)
SELECT model, seed, CASE WHEN CAST(split_part(combined_fold, '_', 1) AS DOUBLE) > 0 THEN 'two_year_scores'
            ELSE 'one_years_scores' END AS fold_type,
       round(avg(rmse), 6) AS rmse, round(stddev_samp(rmse), 6) AS std
FROM r GROUP BY 1, 2, 3""", "f_predictions", "f_labels"))
def fold_stability(spark, sf_dir):
    return round_doubles(rp.fold_stability(_with_combined_fold(spark, sf_dir), by=["model", "seed"]))


@register("seed_stability", with_fixtures("""
WITH p AS (SELECT * FROM f_predictions),
r AS (SELECT model, seed, sqrt(avg((predicted_score - composite_score) ^ 2)) AS rmse FROM p GROUP BY model, seed),
u AS (SELECT model, uid, stddev_samp(predicted_score) AS s FROM p GROUP BY model, uid)
SELECT model, 'rmse_mean' AS metric, round(avg(rmse), 6) AS value FROM r GROUP BY model
UNION ALL SELECT model, 'rmse_std', round(stddev_samp(rmse), 6) FROM r GROUP BY model
UNION ALL SELECT model, 'mean_uid_std', round(avg(s), 6) FROM u GROUP BY model""", "f_predictions"))
def seed_stability(spark, sf_dir):
    return round_doubles(rp.seed_stability(fixture(spark, sf_dir, "f_predictions"), by=["model"]))


@register("mean_by_year", with_fixtures("""
SELECT year, round(avg(predicted_score), 6) AS mean_predicted, round(min(predicted_score), 6) AS min_predicted,
       round(max(predicted_score), 6) AS max_predicted FROM f_predictions GROUP BY year""", "f_predictions"))
def mean_by_year(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    return round_doubles(p.groupBy("year").agg(
        F.avg("predicted_score").alias("mean_predicted"), F.min("predicted_score").alias("min_predicted"),
        F.max("predicted_score").alias("max_predicted")))


def _poisson_case(u: str) -> str:
    th = rp.poisson1_thresholds()
    arms = " ".join(f"WHEN {u} < {t!r} THEN {k}" for k, t in enumerate(th))
    return f"CASE {arms} ELSE {len(th)} END"


def _boot_sql(by: list[str], extra_where: str = "") -> str:
    k = ", ".join(by)
    u = f"((h1 + b * h2) % {rp.HASH_PRIME}) / {float(rp.HASH_PRIME)!r}"
    return f"""
reps AS (SELECT {k}, b, sum(w * predicted_score) / sum(w) AS mean_b FROM (
           SELECT {k}, predicted_score, b, {_poisson_case(u)} AS w
           FROM (SELECT *, ('0x' || substr(md5(concat_ws('|', uid, seed, 42)), 1, 8))::BIGINT AS h1,
                           ('0x' || substr(md5(concat_ws('|', uid, seed, 42)), 9, 8))::BIGINT AS h2
                 FROM f_predictions), range(0, {N_BOOT}) r(b) {extra_where}) GROUP BY {k}, b)"""


@register("poisson_bootstrap_se", with_fixtures(f"""
WITH {_boot_sql(['model', 'year'])},
se AS (SELECT model, year, stddev_samp(mean_b) AS se FROM reps GROUP BY model, year),
base AS (SELECT model, year, count(*) AS n, avg(predicted_score) AS mean FROM f_predictions GROUP BY model, year),
ntrain AS (SELECT count(*) AS n_train FROM f_labels)
SELECT base.model, base.year, base.n, round(base.mean, 6) AS mean, round(se.se, 6) AS se,
       round(se.se * sqrt(base.n / (base.n + n_train)), 6) AS se_scaled,
       round(base.mean - se.se * sqrt(base.n / (base.n + n_train)), 6) AS lower_bound,
       round(base.mean + se.se * sqrt(base.n / (base.n + n_train)), 6) AS upper_bound
FROM base JOIN se USING (model, year), ntrain""", "f_predictions", "f_labels"))
def poisson_bootstrap_se(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    n_train = fixture(spark, sf_dir, "f_labels").count()
    t = rp.bootstrap_se(p, "predicted_score", ["model", "year"], ["uid", "seed"], N_BOOT, 42)
    se_s = rp.scale_se("se", "n", F.col("n") + F.lit(n_train))
    return round_doubles(t.select(
        "model", "year", "n", "mean", "se", se_s.alias("se_scaled"),
        (F.col("mean") - se_s).alias("lower_bound"), (F.col("mean") + se_s).alias("upper_bound")))


@register("bootstrap_difference", with_fixtures(f"""
WITH {_boot_sql(['model', 'year', 'seed'])},
d AS (SELECT model, year, b, max(CASE WHEN seed = 1 THEN mean_b END) - max(CASE WHEN seed = 0 THEN mean_b END) AS d
      FROM reps GROUP BY model, year, b),
se AS (SELECT model, year, stddev_samp(d) AS se_diff FROM d GROUP BY model, year),
base AS (SELECT model, year, count(CASE WHEN seed = 1 THEN 1 END) AS n_treated,
                count(CASE WHEN seed = 0 THEN 1 END) AS n_control,
                avg(CASE WHEN seed = 1 THEN predicted_score END) - avg(CASE WHEN seed = 0 THEN predicted_score END) AS mean_diff
         FROM f_predictions GROUP BY model, year)
SELECT model, year, n_treated, n_control, round(mean_diff, 6) AS mean_diff, round(se_diff, 6) AS se_diff,
       round(mean_diff - se_diff * sqrt(n_treated / (n_treated + n_control)), 6) AS lower_bound_diff,
       round(mean_diff + se_diff * sqrt(n_treated / (n_treated + n_control)), 6) AS upper_bound_diff
FROM base JOIN se USING (model, year)""", "f_predictions"))
def bootstrap_difference(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    t = rp.bootstrap_difference(p, "predicted_score", ["model", "year"], "seed", 1, 0, ["uid", "seed"], N_BOOT, 42)
    se_s = rp.scale_se("se_diff", "n_treated", F.col("n_treated") + F.col("n_control"))
    return round_doubles(t.select(
        "model", "year", "n_treated", "n_control", "mean_diff", "se_diff",
        (F.col("mean_diff") - se_s).alias("lower_bound_diff"),
        (F.col("mean_diff") + se_s).alias("upper_bound_diff")))


@register("scenario_effect_topn", with_fixtures(f"""
WITH bl AS (SELECT year, avg(composite_score) AS bb FROM f_labels GROUP BY year),
np AS (SELECT p.uid, p.year, p.seed, p.model || '@' || CAST(p.seed AS VARCHAR) AS scenario,
              (p.predicted_score - bl.bb) / bl.bb * 100 AS predicted_score
       FROM f_predictions p JOIN bl ON p.year = bl.year),
{_boot_sql(['scenario', 'year']).replace('FROM f_predictions, range', 'FROM np, range').replace('FROM f_predictions)', 'FROM np)')},
se AS (SELECT scenario, year, stddev_samp(mean_b) AS se FROM reps GROUP BY scenario, year),
base AS (SELECT scenario, year, count(*) AS n, avg(predicted_score) AS mean FROM np GROUP BY scenario, year),
nt AS (SELECT count(*) AS n_train FROM f_labels),
t AS (SELECT scenario, year, mean, sqrt(n / (n + n_train)) AS f, se FROM base JOIN se USING (scenario, year), nt),
w AS (SELECT scenario,
             round(max(CASE WHEN year = 2016 THEN mean END), 6) AS mean_2016,
             round(max(CASE WHEN year = 2016 THEN mean - se * f * f END), 6) AS lower_bound_2016,
             round(max(CASE WHEN year = 2016 THEN mean + se * f * f END), 6) AS upper_bound_2016,
             round(max(CASE WHEN year = 2021 THEN mean END), 6) AS mean_2021,
             round(max(CASE WHEN year = 2021 THEN mean - se * f * f END), 6) AS lower_bound_2021,
             round(max(CASE WHEN year = 2021 THEN mean + se * f * f END), 6) AS upper_bound_2021
      FROM t GROUP BY scenario)
(SELECT * FROM w ORDER BY mean_2021 ASC LIMIT 5)
UNION ALL
(SELECT * FROM w ORDER BY mean_2021 DESC LIMIT 5)""", "f_predictions", "f_labels"))
def scenario_effect_topn(spark, sf_dir):
    """Percent change of each scenario to the yearly baseline with its band, bottom and top 5."""
    p = fixture(spark, sf_dir, "f_predictions").withColumn(
        "scenario", F.concat_ws("@", "model", F.col("seed").cast("string")))
    lab = fixture(spark, sf_dir, "f_labels")
    p = p.join(lab.groupBy("year").agg(F.avg("composite_score").alias("_b")), "year").withColumn(
        "predicted_score", rp.percent_change("predicted_score", "_b"))
    t = rp.effect_band(p, "predicted_score", "scenario", ["uid", "seed"], [2016, 2021], lab.count(), n_boot=N_BOOT)
    return rp.top_bottom(round_doubles(t), "mean_2021", 5)


@register("score_histogram", with_fixtures("""
WITH s AS (SELECT model, 'predicted_score' AS series, predicted_score AS x FROM f_predictions
           UNION ALL SELECT model, 'composite_score', composite_score FROM f_predictions)
SELECT model, series, CAST(CASE WHEN x < 0 THEN 0 WHEN x >= 2000 THEN 21 ELSE floor((x - 0) / 2000 * 20) + 1 END AS BIGINT) AS bucket,
       count(*) AS n FROM s GROUP BY 1, 2, 3""", "f_predictions"))
def score_histogram(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    return rp.score_histogram(p, ["predicted_score", "composite_score"], 0.0, 2000.0, 20, ["model"])


@register("average_precision", with_fixtures("""
WITH d AS (SELECT model, predicted_score AS s, sum(CASE WHEN composite_score > 1000 THEN 1 ELSE 0 END) AS pos,
                  count(*) AS cnt FROM f_predictions GROUP BY model, predicted_score),
c AS (SELECT model, pos, sum(pos) OVER (PARTITION BY model ORDER BY s DESC) AS tp,
             sum(cnt) OVER (PARTITION BY model ORDER BY s DESC) AS n FROM d)
SELECT model, round(sum(pos * tp / n) / sum(pos), 6) AS average_precision FROM c GROUP BY model""",
                                             "f_predictions"))
def average_precision(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions").withColumn(
        "high", (F.col("composite_score") > 1000).cast("int"))
    return round_doubles(rp.average_precision(p, "high", "predicted_score", ["model"]))


@register("average_precision_nullable", with_fixtures(f"""
WITH {PG_SQL},
d AS (SELECT grp, predicted_score AS s, sum(CASE WHEN composite_score > 1000 THEN 1 ELSE 0 END) AS pos,
             count(*) AS cnt FROM pg GROUP BY grp, predicted_score),
c AS (SELECT grp, pos, sum(pos) OVER (PARTITION BY grp ORDER BY s DESC) AS tp,
             sum(cnt) OVER (PARTITION BY grp ORDER BY s DESC) AS n FROM d)
SELECT grp, round(sum(pos * tp / n) / sum(pos), 6) AS average_precision FROM c GROUP BY grp""",
                                                      "f_predictions", "f_labels_nullkey"))
def average_precision_nullable(spark, sf_dir):
    """By a nullable group: rows without a group are a group of their own."""
    p = _preds_with_group(spark, sf_dir).withColumn("high", (F.col("composite_score") > 1000).cast("int"))
    return round_doubles(rp.average_precision(p, "high", "predicted_score", ["grp"]))


@register("rmse_by_participation", with_fixtures("""
WITH fy AS (SELECT uid, CASE WHEN glob_hlth_03 IS NULL THEN [2012] ELSE [2003, 2012] END AS fyears FROM f_features),
ly AS (SELECT uid, list(year) AS lyears FROM f_labels GROUP BY uid),
pat AS (SELECT fy.uid, list_sort(list_concat(fy.fyears, coalesce(ly.lyears, []))) AS years
        FROM fy LEFT JOIN ly ON fy.uid = ly.uid),
p AS (SELECT p.*, '[' || array_to_string(pat.years, ', ') || ']' AS pattern,
             CAST(list_contains(pat.years, 2003) AS INTEGER) AS has_2003,
             CAST(list_contains(pat.years, 2012) AS INTEGER) AS has_2012,
             CAST(list_contains(pat.years, 2016) AS INTEGER) AS has_2016,
             CAST(list_contains(pat.years, 2021) AS INTEGER) AS has_2021
      FROM f_predictions p JOIN pat ON p.uid = pat.uid)
SELECT model, pattern, has_2003, has_2012, has_2016, has_2021,
       round(sqrt(avg((predicted_score - composite_score) ^ 2)), 6) AS rmse, count(*) AS num_samples
FROM p GROUP BY model, pattern, has_2003, has_2012, has_2016, has_2021""", "f_predictions", "f_features", "f_labels"))
def rmse_by_participation(spark, sf_dir):
    """RMSE by participation pattern with presence flags."""
    pat = rp.participation_years(fixture(spark, sf_dir, "f_features"), fixture(spark, sf_dir, "f_labels"),
                                 "glob_hlth_03")
    pat = rp.year_flags(pat, "years", [2003, 2012, 2016, 2021])
    p = fixture(spark, sf_dir, "f_predictions").join(pat, "uid")
    return round_doubles(rp.rmse(p, ["model", "pattern", "has_2003", "has_2012", "has_2016", "has_2021"]))


def _normalized_preds(spark, sf_dir):
    p = fixture(spark, sf_dir, "f_predictions")
    base = fixture(spark, sf_dir, "f_labels").groupBy("year").agg(F.avg("composite_score").alias("_b"))
    # one row per label year
    p = p.join(base, "year")
    return p.withColumn("predicted_score", rp.percent_change("predicted_score", "_b")).withColumn(
        "category", F.when(F.col("seed") == 1, F.lit("1_0")).otherwise(F.lit("0_0")))


@register("activity_effect_table", with_fixtures(f"""
WITH b AS (SELECT year, avg(composite_score) AS bb FROM f_labels GROUP BY year),
np AS (SELECT p.uid, p.year, p.model, p.seed, (p.predicted_score - b.bb) / b.bb * 100 AS predicted_score
       FROM f_predictions p JOIN b ON p.year = b.year),
{_boot_sql(['model', 'year', 'seed']).replace('FROM f_predictions)', 'FROM np)')},
d AS (SELECT model, year, b, max(CASE WHEN seed = 1 THEN mean_b END) - max(CASE WHEN seed = 0 THEN mean_b END) AS d
      FROM reps GROUP BY model, year, b),
se AS (SELECT model, year, stddev_samp(d) AS se_diff FROM d GROUP BY model, year),
base AS (SELECT model, year, count(CASE WHEN seed = 1 THEN 1 END) AS nt, count(CASE WHEN seed = 0 THEN 1 END) AS nc,
                avg(CASE WHEN seed = 1 THEN predicted_score END) - avg(CASE WHEN seed = 0 THEN predicted_score END) AS md
         FROM np GROUP BY model, year),
t AS (SELECT model, year, md, md - se_diff * sqrt(nt / (nt + nc)) AS lo, md + se_diff * sqrt(nt / (nt + nc)) AS hi,
             sqrt(nt / (nt + nc)) AS f FROM base JOIN se USING (model, year)),
t2 AS (SELECT model, year, md, (hi + lo) / 2 - (hi - lo) / 2 * f AS lo2, (hi + lo) / 2 + (hi - lo) / 2 * f AS hi2 FROM t)
SELECT model,
       round(max(CASE WHEN year = 2016 THEN md END), 6) AS mean_diff_2016,
       round(max(CASE WHEN year = 2016 THEN lo2 END), 6) AS lower_bound_diff_2016,
       round(max(CASE WHEN year = 2016 THEN hi2 END), 6) AS upper_bound_diff_2016,
       round(max(CASE WHEN year = 2021 THEN md END), 6) AS mean_diff_2021,
       round(max(CASE WHEN year = 2021 THEN lo2 END), 6) AS lower_bound_diff_2021,
       round(max(CASE WHEN year = 2021 THEN hi2 END), 6) AS upper_bound_diff_2021
FROM t2 GROUP BY model""", "f_predictions", "f_labels"))
def activity_effect_table(spark, sf_dir):
    """Category ``1_0`` vs ``0_0`` effect in % of the yearly baseline, wide by year."""
    p = _normalized_preds(spark, sf_dir)
    return round_doubles(rp.effect_table(p, "predicted_score", "model", "category", "1_0", "0_0",
                                         ["uid", "seed"], [2016, 2021], "year", N_BOOT, 42))


@register("attach_truth", with_fixtures("""
SELECT p.uid, p.year, p.model, p.seed, round(p.predicted_score, 6) AS predicted_score,
       round(l.composite_score, 6) AS composite_score
FROM f_predictions p LEFT JOIN f_labels_nullkey l ON p.uid = l.uid AND p.year = l.year""",
                                        "f_predictions", "f_labels_nullkey"))
def attach_truth(spark, sf_dir):
    """Long predictions without the target, truth attached by key."""
    p = fixture(spark, sf_dir, "f_predictions").drop("composite_score")
    return round_doubles(rp.attach_truth(p, fixture(spark, sf_dir, "f_labels_nullkey")))
