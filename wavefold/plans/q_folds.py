"""Fold plans (K4–K6)."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import clean as cl
from ..operators import folds as fo
from .fixtures import fixture, with_fixtures
from .registry import register


def _md5_bucket_sql(k: int, *parts: str) -> str:
    inner = ", ".join(parts)
    return f"CAST((('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT % {k}) + 1 AS INTEGER)"


@register("kfold_md5", with_fixtures(f"""
SELECT uid, year, {_md5_bucket_sql(5, 'uid', '42')} AS fold FROM f_labels""", "f_labels"))
def kfold_md5(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    return fo.kfold(lab, "uid", 5, 42)


@register("kfold_balanced", with_fixtures("""
SELECT uid, year,
       CAST((row_number() OVER (ORDER BY md5(concat_ws('|', uid, year, 7)), uid, year) - 1) % 5 + 1 AS INTEGER) AS fold
FROM f_labels""", "f_labels"))
def kfold_balanced(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    return fo.kfold(lab, ["uid", "year"], 5, 7, balanced=True)


@register("combined_fold", with_fixtures(f"""
WITH pairs AS (SELECT uid FROM f_labels GROUP BY uid HAVING count(*) = 2),
f1 AS (SELECT uid, {_md5_bucket_sql(5, 'uid', '42')} AS fold1 FROM pairs)
SELECT l.uid, l.year, coalesce(f1.fold1, 0) AS fold1,
       CAST(coalesce(f1.fold1, 0) AS VARCHAR) || '_' || CAST({_md5_bucket_sql(5, 'l.uid', 'l.year', '42')} AS VARCHAR)
         AS combined_fold
FROM f_labels l LEFT JOIN f1 ON l.uid = f1.uid""", "f_labels"))
def combined_fold(spark, sf_dir):
    lab = fixture(spark, sf_dir, "f_labels").select("uid", "year")
    f1 = fo.kfold(cl.complete_pairs(lab), "uid", 5, 42, out="fold1")
    return fo.combined_fold(lab, f1, "uid", 5, 42)


GROUP_KFOLD_SQL = """
WITH RECURSIVE f_members AS ({members}),
g AS (
  SELECT grp, count(*) AS n,
         row_number() OVER (ORDER BY count(*) DESC, grp NULLS FIRST) AS rn
  FROM f_members GROUP BY grp),
r(rn, loads, grp, fold) AS (
  SELECT 0, [0, 0, 0, 0, 0]::BIGINT[], NULL::VARCHAR, NULL::INTEGER
  UNION ALL
  SELECT g.rn,
         list_transform(r.loads, lambda x, i: CASE WHEN i = list_position(r.loads, list_min(r.loads)) THEN x + g.n ELSE x END),
         g.grp, CAST(list_position(r.loads, list_min(r.loads)) AS INTEGER)
  FROM r JOIN g ON g.rn = r.rn + 1)
SELECT f.uid, f.grp, r.fold FROM f_members f JOIN r ON r.rn > 0 AND f.grp IS NOT DISTINCT FROM r.grp"""


@register("group_kfold", with_fixtures(GROUP_KFOLD_SQL.replace(
    "{members}", "SELECT uid, CAST(bmi_12 AS VARCHAR) AS grp FROM f_features"), "f_features"))
def group_kfold(spark, sf_dir):
    """Whole nations per fold, greedy size balance."""
    f = fixture(spark, sf_dir, "f_features").select("uid", F.col("bmi_12").cast("string").alias("grp"))
    return fo.group_kfold(f, "grp", 5).select("uid", "grp", "fold")


@register("group_kfold_nullable", with_fixtures(GROUP_KFOLD_SQL.replace(
    "{members}", "SELECT uid, grp FROM f_labels_nullkey"), "f_labels_nullkey"))
def group_kfold_nullable(spark, sf_dir):
    """A nullable grouping column: rows without a group are one group."""
    f = fixture(spark, sf_dir, "f_labels_nullkey").select("uid", "grp")
    return fo.group_kfold(f, "grp", 5).select("uid", "grp", "fold")
