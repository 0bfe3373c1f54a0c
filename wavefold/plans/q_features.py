"""Recode, clean and feature plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import clean as cl
from ..operators import features as fe
from .fixtures import fixture, with_fixtures
from .q_reshape import PRIORITIES
from .registry import register

PRIORITY_ORDER = {"glob_hlth_03": PRIORITIES, "glob_hlth_12": PRIORITIES}


def _case_map(col, mapping, default="NULL"):
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {default} END"


@register("ordinal_encode", with_fixtures(f"""
SELECT uid,
       CAST({_case_map('glob_hlth_03', {p: i + 1 for i, p in enumerate(PRIORITIES)})} AS INTEGER) AS glob_hlth_03,
       CAST({_case_map('glob_hlth_12', {p: i + 1 for i, p in enumerate(PRIORITIES[:4])})} AS INTEGER) AS glob_hlth_12
FROM f_features""", "f_features"))
def ordinal_encode(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "glob_hlth_03", "glob_hlth_12")
    # the second wave knows only four labels: the fifth is unknown → NULL
    return cl.ordinal_encode(f, {"glob_hlth_03": PRIORITIES, "glob_hlth_12": PRIORITIES[:4],
                                 "absent_column": PRIORITIES})


SEGMENT_BANDS = {"AUTOMOBILE": 0, "BUILDING": 2, "FURNITURE": 7, "HOUSEHOLD": 8}


@register("band_recode", with_fixtures(f"""
SELECT uid, CAST({_case_map('edu_gru_12', SEGMENT_BANDS, 'TRY_CAST(edu_gru_12 AS DOUBLE)')} AS DOUBLE) AS edu_gru_12
FROM f_features""", "f_features"))
def band_recode(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "edu_gru_12")
    # MACHINERY has no band: unmatched non-numeric text → NULL
    return cl.recode_bands(f, {"edu_gru_12": SEGMENT_BANDS, "absent_column": SEGMENT_BANDS})


AGE_BANDS = {"1-URGENT": (40, 49), "2-HIGH": (50, 59), "3-MEDIUM": (60, 69),
             "4-NOT SPECIFIED": (70, 79), "5-LOW": (80, 100)}

_LO = {k: v[0] for k, v in AGE_BANDS.items()}
_HI = {k: v[1] for k, v in AGE_BANDS.items()}
NARROW_SQL = f"""
CAST(CASE WHEN glob_hlth_03 IS NULL OR glob_hlth_12 IS NULL THEN NULL
     WHEN glob_hlth_03 = glob_hlth_12 THEN {_case_map('glob_hlth_03', _LO)}
     ELSE ({_case_map('glob_hlth_03', _HI)} + {_case_map('glob_hlth_12', _LO)}) / 2.0 END AS DOUBLE)"""


def _narrowed(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    return cl.narrow_age(f, "glob_hlth_03", "glob_hlth_12", AGE_BANDS, 9.0)


@register("narrow_age", with_fixtures(f"""
SELECT uid, {NARROW_SQL} AS narrowed_age_03, {NARROW_SQL} + 9 AS narrowed_age_12 FROM f_features""",
                                      "f_features"))
def narrow_age(spark, sf_dir):
    return _narrowed(spark, sf_dir).select("uid", "narrowed_age_03", "narrowed_age_12")


@register("wave_differences", with_fixtures(f"""
SELECT uid,
  CAST({_case_map('glob_hlth_03', {p: i + 1 for i, p in enumerate(PRIORITIES)})} AS INTEGER)
  - CAST({_case_map('glob_hlth_12', {p: i + 1 for i, p in enumerate(PRIORITIES)})} AS INTEGER) AS glob_hlth_diff,
  round(hincome_03 - hincome_12, 6) AS hincome_diff,
  n_orders_03 - n_orders_12 AS n_orders_diff
FROM f_features""", "f_features"))
def wave_differences(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    f = cl.ordinal_encode(f, PRIORITY_ORDER)
    d = fe.wave_differences(f)
    return round_doubles(d.select("uid", *[c for c in d.columns if c.endswith("_diff")]))


@register("positive_log", with_fixtures("""
SELECT uid, round(CASE WHEN hincome_03 > 0 THEN ln(hincome_03) END, 6) AS hincome_03,
       round(CASE WHEN hincome_12 > 0 THEN ln(hincome_12) END, 6) AS hincome_12,
       round(CASE WHEN hincome_12 - hincome_03 > 0 THEN ln(hincome_12 - hincome_03) END, 6) AS hincome_diff
FROM f_features""", "f_features"))
def positive_log(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select(
        "uid", "hincome_03", "hincome_12", (F.col("hincome_12") - F.col("hincome_03")).alias("hincome_diff"))
    return round_doubles(fe.log_columns(f))


@register("age_interactions", with_fixtures(f"""
WITH a AS (SELECT uid, {NARROW_SQL} + 9 AS age12,
                  CASE WHEN hincome_12 > 0 THEN ln(hincome_12) END AS linc FROM f_features)
SELECT uid, round(age12, 6) AS narrowed_age_12, round(linc, 6) AS hincome_12,
       round(age12 * age12, 6) AS age_squared, round(age12 * linc, 6) AS age_income_interaction FROM a""",
                                            "f_features"))
def age_interactions(spark, sf_dir):
    f = fe.log_columns(_narrowed(spark, sf_dir))
    f = fe.age_interactions(f)
    return round_doubles(f.select("uid", "narrowed_age_12", "hincome_12", "age_squared",
                                  "age_income_interaction"))


@register("winsorize_q99", with_fixtures("""
WITH q AS (SELECT quantile_cont(hincome_03, 0.99) AS q3, quantile_cont(hincome_12, 0.99) AS q12 FROM f_features)
SELECT uid, round(CASE WHEN hincome_03 > q3 THEN q3 ELSE hincome_03 END, 6) AS hincome_03,
       round(CASE WHEN hincome_12 > q12 THEN q12 ELSE hincome_12 END, 6) AS hincome_12
FROM f_features, q""", "f_features"))
def winsorize_q99(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "hincome_03", "hincome_12")
    return round_doubles(cl.winsorize(f, ["hincome_03", "hincome_12"], 0.99))


FIRST_WAVE = ["glob_hlth_03", "hincome_03", "n_orders_03"]
SECOND_WAVE = ["glob_hlth_12", "bmi_12", "edu_gru_12", "hincome_12", "n_orders_12"]


def _nulls_sql(cols):
    return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in cols)


@register("sparse_row_filter", with_fixtures(f"""
SELECT uid, edu_gru_12, bmi_12, glob_hlth_03, glob_hlth_12, round(hincome_03, 6) AS hincome_03,
       round(hincome_12, 6) AS hincome_12, n_orders_03, n_orders_12
FROM f_features
WHERE ({_nulls_sql(FIRST_WAVE)} < {int((len(FIRST_WAVE) + 1) / 2)} OR {_nulls_sql(FIRST_WAVE)} = 75)
  AND ({_nulls_sql(SECOND_WAVE)} < {int((len(SECOND_WAVE) + 1) / 2)} OR {_nulls_sql(SECOND_WAVE)} > 100)""",
                                             "f_features"))
def sparse_row_filter(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    return round_doubles(cl.drop_sparse_rows(f, FIRST_WAVE, SECOND_WAVE, 75, 100))


@register("fill_quantile", with_fixtures("""
WITH q AS (SELECT quantile_cont(hincome_03, 0.5) AS m3, quantile_cont(hincome_12, 0.5) AS m12 FROM f_features)
SELECT uid, round(coalesce(hincome_03, m3), 6) AS hincome_03, round(coalesce(hincome_12, m12), 6) AS hincome_12,
       coalesce(glob_hlth_03, 'missing') AS glob_hlth_03
FROM f_features, q""", "f_features"))
def fill_quantile(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features").select("uid", "hincome_03", "hincome_12", "glob_hlth_03")
    fills = cl.fit_fill_quantile(f, ["hincome_03", "hincome_12"], 0.5)
    fills["glob_hlth_03"] = "missing"
    return round_doubles(cl.fill_values(f, fills))


@register("align_schema", with_fixtures("""
SELECT uid, round(hincome_12, 6) AS hincome_12, 0 AS not_in_test, bmi_12 FROM f_features""", "f_features"))
def align_schema(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    return round_doubles(cl.align_schema(f, ["uid", "hincome_12", "not_in_test", "bmi_12"], 0))


@register("complete_pair_semi", with_fixtures("""
SELECT uid, year, round(composite_score, 6) AS composite_score FROM f_labels
WHERE uid IN (SELECT uid FROM f_labels GROUP BY uid HAVING count(*) = 2)""", "f_labels"))
def complete_pair_semi(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels")
    return round_doubles(cl.semi_join(lab, cl.complete_pairs(lab)))


@register("incomplete_anti", with_fixtures("""
SELECT uid, year, round(composite_score, 6) AS composite_score FROM f_labels
WHERE uid NOT IN (SELECT uid FROM f_labels GROUP BY uid HAVING count(*) = 2)""", "f_labels"))
def incomplete_anti(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels")
    return round_doubles(cl.anti_join(lab, cl.complete_pairs(lab)))


@register("first_row_per_key", with_fixtures("""
SELECT uid, year, round(composite_score, 6) AS composite_score, grp FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY year) AS rn FROM f_labels_nullkey) WHERE rn = 1""",
                                             "f_labels_nullkey"))
def first_row_per_key(spark, sf_dir):
    df = fixture(spark, sf_dir, "f_labels_nullkey")
    return round_doubles(cl.first_per_key(df, "uid", ["year"]))


def _edges_sql(table, col, probs):
    return ", ".join(f"quantile_cont({col}, {p}) AS e{i}" for i, p in enumerate(probs)) + f" FROM {table}"


def _bin_case(col, n_edges):
    arms = " ".join(f"WHEN {col} <= e{i} THEN {i - 1}" for i in range(1, n_edges))
    return f"CAST(CASE WHEN {col} IS NULL OR {col} < e0 OR {col} > e{n_edges - 1} THEN NULL {arms} END AS INTEGER)"


@register("quantile_bins_train_edges", with_fixtures(f"""
WITH e AS (SELECT {_edges_sql("f_labels WHERE year = 2016", "composite_score", [0, 0.25, 0.5, 0.75, 1])})
SELECT uid, year, round(composite_score, 6) AS composite_score, {_bin_case("composite_score", 5)} AS composite_score_q
FROM f_labels, e WHERE year = 2021""", "f_labels"))
def quantile_bins_train_edges(spark, sf_dir):
    """Edges fitted on the 2016 rows, applied to the 2021 rows (out of range → NULL)."""
    lab = fixture(spark, sf_dir, "f_labels")
    bins = fe.fit_bins(lab.where(F.col("year") == 2016), ["composite_score"], 4)
    return round_doubles(bins.apply(lab.where(F.col("year") == 2021)))


@register("qcut_codes", with_fixtures(f"""
WITH e AS (SELECT {_edges_sql("f_labels", "composite_score", [i / 10 for i in range(11)])})
SELECT uid, year, {_bin_case("composite_score", 11)} AS decile,
       'q' || CAST({_bin_case("composite_score", 11)} + 1 AS VARCHAR) AS decile_label
FROM f_labels, e""", "f_labels"))
def qcut_codes(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels")
    x = fe.qcut(lab, "composite_score", 10, out="decile")
    x = fe.qcut(x, "composite_score", 10, out="decile_label", labels=True)
    return x.select("uid", "year", "decile", "decile_label")


@register("topk_other", with_fixtures("""
WITH top AS (SELECT CAST(bmi_12 AS VARCHAR) AS v, count(*) AS n FROM f_features
             GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 6)
SELECT uid, CASE WHEN CAST(bmi_12 AS VARCHAR) IN (SELECT v FROM top) THEN CAST(bmi_12 AS VARCHAR)
            ELSE 'other' END AS category
FROM f_features""", "f_features"))
def topk_other(spark, sf_dir):
    f = fixture(spark, sf_dir, "f_features")
    tk = fe.fit_top_k(f, "bmi_12", 6)
    return tk.apply(f, out="category").select("uid", "category")
