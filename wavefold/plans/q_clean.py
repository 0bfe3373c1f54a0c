"""Plans for column tools and small filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..operators import blend as bl
from ..operators import clean as cl
from ..operators import groupstats as gs
from ..operators import participation as pa
from .fixtures import fixture, with_fixtures
from .registry import register


@register("select_wave_columns", with_fixtures("""
SELECT uid, glob_hlth_12 AS glob_hlth, edu_gru_12 AS edu_gru, n_orders_12 AS n_orders FROM f_features""", "f_features"))
def select_wave_columns(spark, sf_dir):
    """One wave by name pattern, its suffix stripped, two columns dropped if there."""
    f = fixture(spark, sf_dir, "f_features")
    one = cl.strip_suffix(cl.select_regex(f, "^uid$|_12$"), "_12")
    return cl.drop_existing(one, ["hincome", "bmi", "not_there"])


@register("numeric_wave_means", with_fixtures("""
SELECT 'n_orders_03' AS column_name, round(avg(n_orders_03), 6) AS mean FROM f_features
UNION ALL SELECT 'n_orders_12', round(avg(n_orders_12), 6) FROM f_features""", "f_features"))
def numeric_wave_means(spark, sf_dir):
    """Columns chosen by type, prefix and excluded words, averaged in one pass."""
    f = fixture(spark, sf_dir, "f_features")
    numeric = set(cl.columns_by_type(f, ["int", "bigint", "double"]))
    chosen = [c for c in cl.columns_excluding(f, ["hincome", "bmi"]) if c in numeric]
    chosen = [c for c in cl.columns_with_prefix(f, "n_", not_suffix="_diff") if c in chosen]
    return round_doubles(f.agg(*[F.avg(c).alias(c) for c in chosen]).unpivot([], chosen, "column_name", "mean"))


@register("schema_difference", with_fixtures("""
SELECT column_name, side FROM (VALUES
  ('edu_gru_12', 'missing_in_right'), ('bmi_12', 'missing_in_right'), ('glob_hlth_03', 'missing_in_right'),
  ('glob_hlth_12', 'missing_in_right'), ('hincome_03', 'missing_in_right'), ('hincome_12', 'missing_in_right'),
  ('n_orders_03', 'missing_in_right'), ('n_orders_12', 'missing_in_right'),
  ('year', 'missing_in_left'), ('composite_score', 'missing_in_left')) t(column_name, side)
WHERE (SELECT count(*) FROM f_features) >= 0 AND (SELECT count(*) FROM f_labels) >= 0""", "f_features", "f_labels"))
def schema_difference(spark, sf_dir):
    """Columns on one side only."""
    d = cl.schema_difference(spark, fixture(spark, sf_dir, "f_features"), fixture(spark, sf_dir, "f_labels"))
    return d.withColumnRenamed("column", "column_name")


@register("first_named_columns", with_fixtures("""
SELECT uid, year, round(composite_score, 6) AS composite_score FROM f_labels""", "f_labels"))
def first_named_columns(spark, sf_dir):
    """Of columns that repeat a name the first stays."""
    lab = fixture(spark, sf_dir, "f_labels")
    names = [*lab.columns, "uid", "year"]
    twice = lab.select(*lab.columns, F.lit(-1).alias("uid"), F.lit(-1).alias("year")).toDF(*[f"c{i}" for i in range(len(names))])
    keep = cl.dedupe_column_names(names)
    return round_doubles(twice.select(*[F.col(f"c{i}").alias(names[i]) for i in keep]))


@register("drop_any_null", with_fixtures("""
SELECT uid, glob_hlth_03, glob_hlth_12 FROM f_features
WHERE glob_hlth_03 IS NOT NULL AND glob_hlth_12 IS NOT NULL AND hincome_03 IS NOT NULL AND hincome_12 IS NOT NULL""", "f_features"))
def drop_any_null(spark, sf_dir):
    """Rows without a null in any of the columns."""
    f = fixture(spark, sf_dir, "f_features")
    return cl.drop_any_null(f, ["glob_hlth_03", "glob_hlth_12", "hincome_03", "hincome_12"]).select("uid", "glob_hlth_03", "glob_hlth_12")


@register("contains_any", with_fixtures("""
SELECT uid, glob_hlth_03 FROM f_features WHERE glob_hlth_03 LIKE '%URGENT%' OR glob_hlth_03 LIKE '%LOW%'""", "f_features"))
def contains_any(spark, sf_dir):
    """Rows whose text contains one of the words (F8)."""
    return cl.filter_contains_any(fixture(spark, sf_dir, "f_features").select("uid", "glob_hlth_03"), "glob_hlth_03", ["URGENT", "LOW"])


@register("clamped_final", with_fixtures("""
SELECT uid, year, CAST(ceil(avg(greatest(predicted_score, 300.0))) AS DOUBLE) AS composite_score
FROM f_predictions GROUP BY uid, year""", "f_predictions"))
def clamped_final(spark, sf_dir):
    """Every seed's score raised to a minimum before the mean (X11)."""
    return bl.finalize(fixture(spark, sf_dir, "f_predictions"), value="predicted_score", min_score=300.0, clamp_first=True)


@register("group_stats_guarded", with_fixtures("""
SELECT 'grp' AS group_var, grp AS group_value, round(min(composite_score), 6) AS min, round(max(composite_score), 6) AS max,
       round(avg(composite_score), 6) AS mean
FROM f_labels_nullkey WHERE grp IS NOT NULL GROUP BY grp""", "f_labels_nullkey"))
def group_stats_guarded(spark, sf_dir):
    """Grouping columns that are not there are skipped, and can be listed."""
    df = fixture(spark, sf_dir, "f_labels_nullkey")
    assert gs.missing_group_vars(df, ["grp", "not_there"]) == ["not_there"]
    st = gs.group_stats_multi(df, ["grp", "not_there"], "composite_score")
    return round_doubles(st.select("group_var", "group_value", "min", "max", "mean"))


@register("participation_unseen", with_fixtures("""
WITH pat AS (SELECT uid, '[' || array_to_string(list_sort(list(year)), ', ') || ']' AS pattern FROM f_labels GROUP BY uid),
voc AS (SELECT pattern, CAST(dense_rank() OVER (ORDER BY pattern) AS INTEGER) AS year_participation
        FROM (SELECT DISTINCT pattern FROM pat WHERE pattern <> '[2016, 2021]'))
SELECT pat.uid, voc.year_participation FROM pat LEFT JOIN voc USING (pattern)""", "f_labels"))
def participation_unseen(spark, sf_dir):
    """A vocabulary fitted on keys with one year leaves the two-year pattern without a code (K2)."""
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    pats = pa.year_patterns(lab.where(F.lit(False)), lab)
    vocab = pa.fit_pattern_vocab(pats.where(F.col("pattern") != "[2016, 2021]"))
    return vocab.apply(pats)


@register("sampled_columns", with_fixtures("""
SELECT count(*) AS n_rows, 5 AS n_columns FROM f_features""", "f_features"))
def sampled_columns(spark, sf_dir):
    """Half of the eight droppable columns are dropped, the key stays."""
    f = fixture(spark, sf_dir, "f_features")
    left = cl.sample_columns(f, 0.5, keep=["uid"], seed=42)
    assert "uid" in left.columns
    return left.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(left.columns)))
