"""File-stream scoring: everything landed is scored once, a rerun adds nothing."""

import uuid

from pyspark.sql import functions as F

from wavefold.operators import models as mo
from wavefold.plans import q_models
from wavefold.plans.fixtures import fixture
from wavefold.session import ensure_checkpoint_dir
from wavefold.streaming.scoring import score_files

SF = "/root/testdata/sf0.001"


def test_score_files_restartable(spark):
    lab = fixture(spark, SF, "f_labels")
    raw = fixture(spark, SF, "f_features")
    num, cat = q_models.NUMERIC, q_models.CATEGORICAL
    train = mo.prepare_inputs(lab.join(q_models.encoded_features(raw), "uid", "left")
                              .withColumn("label", F.col("composite_score")), num, cat)
    stages, _ = mo.assembler_stages(train, num, cat)
    model = mo.fit_pipeline(train, stages, mo.make_regressor("forest", {"numTrees": 5}, 1))
    base = f"{ensure_checkpoint_dir(spark)}/stream-test/{uuid.uuid4().hex}"
    rows = lab.select("uid", "year").join(raw, "uid").withColumn("feature_category", F.lit("base"))
    rows.write.mode("overwrite").partitionBy("feature_category").parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    prep = lambda d: mo.prepare_inputs(q_models.encoded_features(d), num, cat)
    for _ in range(2):   # the second run restarts from the checkpoint and finds nothing new
        score_files(spark, f"{base}/in", schema, model, ["uid", "year"], f"{base}/out", f"{base}/_ckpt", prep)
        out = spark.read.parquet(f"{base}/out")
        assert out.count() == rows.count()
        assert out.select("uid", "year").distinct().count() == rows.count()
