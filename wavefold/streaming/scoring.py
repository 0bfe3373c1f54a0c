"""Incremental scoring of scenario files as they land (S6 + M13 + C6).

A file-source stream reads new Parquet files of scenario rows, the fitted
pipeline (imputer, indexers, assembler, model — all row-wise transformers)
scores them, and a Parquet sink partitioned by ``feature_category`` appends
the predictions. The checkpoint location makes the run restartable: files
already scored are not scored again after a failure.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_files(spark: SparkSession, source_dir: str, schema: T.StructType, model: PipelineModel,
                keys: Sequence[str], out_dir: str, checkpoint_dir: str,
                prepare: Callable[[DataFrame], DataFrame] | None = None,
                available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and, with ``available_now``, finish) the scoring stream; returns the query."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    x = prepare(rows) if prepare else rows
    scored = model.transform(x).select(*keys, "feature_category",
                                       F.col("prediction").alias("predicted_score"))
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
              .partitionBy("feature_category"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
