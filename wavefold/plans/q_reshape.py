"""Reshape and participation plans (R1–R8, K1–K3, W6, A3) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import participation as pa
from ..operators import reshape as rs
from ..operators.features import value_counts_long
from .fixtures import PRED_MODELS, PRED_SEEDS, fixture, with_fixtures
from .registry import register

WAVE_COLS = ["uid", "glob_hlth_03", "hincome_03", "glob_hlth_12", "hincome_12"]

WIDE_TO_LONG_SQL = """
SELECT uid, glob_hlth_03 AS glob_hlth, hincome_03 AS hincome, 2003 AS year FROM f_features
WHERE NOT (glob_hlth_03 IS NULL AND hincome_03 IS NULL)
UNION ALL
SELECT uid, glob_hlth_12, hincome_12, 2012 FROM f_features
WHERE NOT (glob_hlth_12 IS NULL AND hincome_12 IS NULL)"""


def _long(spark, sf_dir):
    return rs.wide_to_long(fixture(spark, sf_dir, "f_features").select(*WAVE_COLS), "uid")


@register("wide_to_long", with_fixtures(
    f"SELECT uid, glob_hlth, round(hincome, 6) AS hincome, year FROM ({WIDE_TO_LONG_SQL})", "f_features"))
def wide_to_long(spark, sf_dir):
    return round_doubles(_long(spark, sf_dir))


@register("pivot_relative_change", with_fixtures("""
SELECT uid,
       round(max(CASE WHEN year = 2016 THEN composite_score END), 6) AS composite_score_2016,
       round(max(CASE WHEN year = 2021 THEN composite_score END), 6) AS composite_score_2021,
       round(CAST((max(CASE WHEN year = 2016 THEN composite_score END)
              - max(CASE WHEN year = 2021 THEN composite_score END))
             / NULLIF(max(CASE WHEN year = 2021 THEN composite_score END), 0) AS DOUBLE), 6)
         AS composite_score_diff
FROM f_labels GROUP BY uid""", "f_labels"))
def pivot_relative_change(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels")
    return round_doubles(rs.pivot_change(lab, "uid", "year", "composite_score", 2016, 2021))


@register("pivot_block", with_fixtures("""
SELECT uid,
       round(max(CASE WHEN year = 2016 THEN composite_score END), 6) AS composite_score_2016,
       max(CASE WHEN year = 2016 THEN grp END) AS grp_2016,
       round(max(CASE WHEN year = 2021 THEN composite_score END), 6) AS composite_score_2021,
       max(CASE WHEN year = 2021 THEN grp END) AS grp_2021
FROM f_labels_nullkey GROUP BY uid""", "f_labels_nullkey"))
def pivot_block(spark, sf_dir):
    df = fixture(spark, sf_dir, "f_labels_nullkey")
    return round_doubles(rs.pivot_block(df, "uid", "year", [2016, 2021], ["composite_score", "grp"]))


@register("melt_split", with_fixtures("""
SELECT uid, year, model, seed, round(predicted_score, 6) AS predicted_score FROM f_predictions""",
                                      "f_predictions"))
def melt_split(spark, sf_dir):
    """Wide seed columns ``composite_score_{model}_seed_{s}`` → long."""
    p = fixture(spark, sf_dir, "f_predictions")
    names = [f"composite_score_{m}_seed_{s}" for m, _ in PRED_MODELS for s in PRED_SEEDS]
    wide = p.groupBy("uid", "year").agg(*[
        F.first(F.when((F.col("model") == m) & (F.col("seed") == s), F.col("predicted_score")),
                ignorenulls=True).alias(f"composite_score_{m}_seed_{s}")
        for m, _ in PRED_MODELS for s in PRED_SEEDS])
    return round_doubles(rs.melt_predictions(wide, ["uid", "year"], names))


PATTERN_SQL = f"""
long AS ({WIDE_TO_LONG_SQL}),
allyears AS (SELECT uid, year FROM long UNION ALL SELECT uid, year FROM f_labels),
pat AS (SELECT uid, count(year) AS n_years,
               '[' || array_to_string(list_sort(list(year)), ', ') || ']' AS pattern
        FROM allyears GROUP BY uid),
voc AS (SELECT pattern, CAST(dense_rank() OVER (ORDER BY pattern) AS INTEGER) AS year_participation
        FROM (SELECT DISTINCT pattern FROM pat))"""


@register("participation_code", with_fixtures(f"""
WITH {PATTERN_SQL}
SELECT pat.uid, pat.n_years, pat.pattern, voc.year_participation FROM pat JOIN voc USING (pattern)""",
                                              "f_features", "f_labels"))
def participation_code(spark, sf_dir):
    pats = pa.year_patterns(_long(spark, sf_dir), fixture(spark, sf_dir, "f_labels"))
    vocab = pa.fit_pattern_vocab(pats)
    return pats.join(vocab.table, "pattern", "left").select("uid", "n_years", "pattern", "year_participation")


@register("participation_onehot", with_fixtures(f"""
WITH {PATTERN_SQL}
SELECT pat.uid, voc.year_participation, c.code,
       CASE WHEN voc.year_participation = c.code THEN 1 ELSE 0 END AS flag
FROM pat JOIN voc USING (pattern) CROSS JOIN (SELECT year_participation AS code FROM voc) c""", "f_features", "f_labels"))
def participation_onehot(spark, sf_dir):
    """The one-hot columns in long form, as many as the fitted vocabulary has codes."""
    pats = pa.year_patterns(_long(spark, sf_dir), fixture(spark, sf_dir, "f_labels"))
    vocab = pa.fit_pattern_vocab(pats)
    k = pa.vocab_size(vocab)
    wide = pa.participation_onehot(vocab.apply(pats), k)
    flags = F.array(*[F.struct(F.lit(i).alias("code"), F.col(f"year_participation__{i}").alias("flag"))
                      for i in range(1, k + 1)])
    return wide.select("uid", "year_participation", F.inline(flags))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _onehot_sql_cols(col, values, null_flag=True):
    out = [f"CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS {col}__{v.replace(' ', '_').replace('-', '_')}"
           for v in values]
    if null_flag:
        out.append(f"CASE WHEN {col} IS NULL THEN 1 ELSE 0 END AS {col}__nan")
    return out


@register("onehot_null", with_fixtures(f"""
SELECT uid, {", ".join(_onehot_sql_cols("glob_hlth_03", PRIORITIES) + _onehot_sql_cols("edu_gru_12", SEGMENTS))}
FROM f_features""", "f_features"))
def onehot_null(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "glob_hlth_03", "edu_gru_12")
    oh = rs.fit_onehot(f, ["glob_hlth_03", "edu_gru_12"], null_flag=True)
    return oh.apply(f)


@register("onehot_plain", with_fixtures(f"""
SELECT uid, {", ".join(_onehot_sql_cols("glob_hlth_12", PRIORITIES, False))}
FROM f_features""", "f_features"))
def onehot_plain(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "glob_hlth_12")
    return rs.fit_onehot(f, ["glob_hlth_12"], null_flag=False).apply(f)


@register("value_counts_long", with_fixtures("""
SELECT 'glob_hlth_03' AS Feature, coalesce(glob_hlth_03, 'nan') AS Categories, count(*) AS N FROM f_features GROUP BY 2
UNION ALL
SELECT 'edu_gru_12', coalesce(edu_gru_12, 'nan'), count(*) FROM f_features GROUP BY 2
UNION ALL
SELECT 'bmi_12', coalesce(CAST(bmi_12 AS VARCHAR), 'nan'), count(*) FROM f_features GROUP BY 2""",
                                             "f_features"))
def value_counts(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    return value_counts_long(f, ["glob_hlth_03", "edu_gru_12", "bmi_12"])


@register("dense_codes", with_fixtures("""
SELECT uid, year, dense_rank() OVER (ORDER BY uid) - 1 AS uid_num FROM f_labels""", "f_labels"))
def dense_codes(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    return pa.dense_codes(lab, "uid", "uid_num")


@register("union_waves", with_fixtures("""
SELECT uid, glob_hlth_03 AS glob_hlth, NULL::VARCHAR AS edu_gru, 2003 AS year FROM f_features
UNION ALL
SELECT uid, glob_hlth_12, edu_gru_12, 2012 FROM f_features""", "f_features"))
def union_waves(spark, sf_dir):
    """Union by name with a column missing on one side."""
    f = fixture(spark, sf_dir, "f_features")
    a = f.select("uid", F.col("glob_hlth_03").alias("glob_hlth"), F.lit(2003).alias("year"))
    b = f.select("uid", F.col("glob_hlth_12").alias("glob_hlth"), F.col("edu_gru_12").alias("edu_gru"),
                 F.lit(2012).alias("year"))
    return rs.union_all([a, b])
