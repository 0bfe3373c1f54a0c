"""Source/sink plans (S1–S6): round trips through the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.exprs import round_doubles
from ..session import ensure_checkpoint_dir
from ..sources import io
from .fixtures import fixture, with_fixtures
from .registry import register

FEATURE_SCHEMA = ("uid bigint, edu_gru_12 string, bmi_12 int, glob_hlth_03 string, glob_hlth_12 string, "
                  "hincome_03 double, hincome_12 double, n_orders_03 bigint, n_orders_12 bigint")


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/io/{name}-{uuid.uuid4().hex}"


@register("csv_roundtrip", with_fixtures("""
SELECT uid, edu_gru_12, bmi_12, glob_hlth_03, glob_hlth_12, round(hincome_03, 6) AS hincome_03,
       round(hincome_12, 6) AS hincome_12, n_orders_03, n_orders_12 FROM f_features""", "f_features"))
def csv_roundtrip(spark, sf_dir):
    """Write the wide table as CSV with ``NA`` for missing, read it back typed."""
    path = _scratch(spark, "features_csv")
    io.write_csv(fixture(spark, sf_dir, "f_features"), path, null_value="NA")
    return round_doubles(io.read_survey_csv(spark, path, FEATURE_SCHEMA))


# lines of the wide table, of which some have a field too many or too few, or a word where a number should be
@register("csv_rejected", with_fixtures("""
WITH r AS (SELECT CASE uid % 10 WHEN 3 THEN 'width' WHEN 4 THEN 'width' WHEN 7 THEN 'type: bmi_12' WHEN 8 THEN 'type: bmi_12, n_orders_03'
                  ELSE 'good' END AS reason, bmi_12 FROM f_features)
SELECT reason, count(*) AS n, CAST(sum(CASE WHEN reason = 'good' THEN bmi_12 END) AS BIGINT) AS sum_bmi FROM r GROUP BY reason""", "f_features"))
def csv_rejected(spark, sf_dir):
    """Lines of the wrong width or type go to a side table, the others are typed."""
    path, kind = _scratch(spark, "lines"), F.col("uid") % 10
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    line = F.concat_ws(",", text("uid"), F.when(kind == 7, F.lit("tall")).when(kind == 8, F.lit("1x")).otherwise(text("bmi_12")),
                       F.when(kind != 3, text("hincome_12")), F.when(kind == 8, F.lit("two")).otherwise(text("n_orders_03")),
                       F.when(kind == 4, F.lit("more")))
    # one column whose name is the header; without quotes, as it is several fields to a reader
    lines = fixture(spark, sf_dir, "f_features").select(line.alias("uid,bmi_12,hincome_12,n_orders_03"))
    lines.write.option("header", True).option("sep", "\t").option("quote", "\u0000").csv(path)
    good, rejected = io.read_checked_csv(spark, path, "uid bigint, bmi_12 int, hincome_12 double, n_orders_03 bigint")
    return good.select(F.lit("good").alias("reason"), F.col("bmi_12").cast("long").alias("b")).unionByName(
        rejected.select("reason", F.lit(None).cast("long").alias("b"))).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("b").alias("sum_bmi"))


@register("tagged_scan", with_fixtures("""
SELECT uid, year, seed, round(predicted_score, 6) AS predicted_score, model AS source_tag FROM f_predictions""",
                                       "f_predictions"))
def tagged_scan(spark, sf_dir):
    """One folder per model, scanned by a glob and tagged from the path."""
    path = _scratch(spark, "preds")
    p = fixture(spark, sf_dir, "f_predictions").select("uid", "year", "seed", "predicted_score", "model")
    io.write_table(p, path, partition_by=["model"])
    t = io.read_tagged(spark, f"{path}/model=*", "source_tag", r"model=([^/]+)/")
    return round_doubles(t.select("uid", "year", "seed", "predicted_score", "source_tag"))


@register("bundle_roundtrip", with_fixtures("""
SELECT model, count(*) AS n, round(avg(predicted_score), 6) AS mean_predicted, 5 AS n_seeds
FROM f_predictions GROUP BY model""", "f_predictions"))
def bundle_roundtrip(spark, sf_dir):
    """Result bundle with run parameters written and read back."""
    path = _scratch(spark, "bundle")
    p = fixture(spark, sf_dir, "f_predictions")
    summary = p.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg("predicted_score").alias("mean_predicted"))
    io.write_bundle({"summary": summary}, {"n_seeds": 5, "n_trials": 5}, path)
    tables, params = io.read_bundle(spark, path, ["summary"])
    return round_doubles(tables["summary"].withColumn("n_seeds", F.lit(int(params["n_seeds"]))))
