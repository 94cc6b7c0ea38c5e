"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, where the session does not say how large: a Python worker holds each several times over,
    and on large splits Spark's own bound is a multiple of that."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, DEFAULT_CONF[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    On a cluster the setting must name a shared file system. Only a local-mode
    session without the setting (tests, the bench) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TESSERA_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: cuts lineage, keeps column
    pruning and filter push-down, and gives the optimizer a size. For wide rows (text, token ids)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tessera-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
