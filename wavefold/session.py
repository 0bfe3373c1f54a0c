"""Session helpers.

The library never creates a cluster session on its own: callers pass a
``SparkSession``. ``local_session`` is for tests, the bench and the examples.
``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session (the
shared folder a cluster names) and only invents a scratch folder when the
session runs in local mode and nothing is configured.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wavefold") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WAVEFOLD_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session conf.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we never
    fall back to a machine-local folder there. In local mode (tests) an unset
    value is replaced by a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    scratch = tempfile.mkdtemp(prefix="wavefold-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the session's checkpoint folder.

    Used wherever two actions must see the same materialised rows (range
    partition bounds are sampled per action) and to cut long lineages so a lost
    executor does not recompute a whole pipeline.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
