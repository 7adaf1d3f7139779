"""Session construction and the shared scratch location.

The reports need two session-level guarantees:

* ``spark.sql.session.timeZone=UTC`` so that rendering timestamps never
  depends on the host (year extraction itself is zone-free, see
  :func:`marquee.functions.scalar.epoch_year`);
* AQE on, so join strategies, skew splits and partition counts are decided
  from runtime sizes instead of hints.

Anything that has to be materialised (sinks read back by the checks, lineage
cuts) goes below the folder named by ``spark.checkpoint.dir``. That setting
belongs to the cluster and is required there; only a local session without
one uses its warehouse folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "marquee",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and written intermediates.

    ``spark.checkpoint.dir`` of the session. Where it is unset, a local session
    gets a folder of its warehouse; on a cluster that is an error, since the
    default warehouse may be a folder of one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "marquee", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the application's scratch folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet to the shared scratch folder and read back.

    Its lineage ends there, a lost executor costs nothing, and joins see its true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_scratch(spark: SparkSession) -> None:
    """Removes what this application has written to its scratch folder.

    For the end of an application: results that still read from it are lost.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
