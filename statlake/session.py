"""Session construction and the shared scratch location.

Everything that has to be written between jobs (CSV round trips, published
fact partitions, ledger events) goes below ``spark.checkpoint.dir``: on a
cluster that is a shared folder every executor can reach.  A machine-local
temporary folder is only used when the setting is absent, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet min/max statistics let the year / area filters skip row groups
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "statlake", extra: dict | None = None) -> SparkSession:
    """A session with the library's defaults.  Master and shuffle partitions
    stay as submitted unless the caller asks for others."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        # reducers start fine-grained; AQE merges small ones by measured size
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "1000"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first.  Only a local session (tests) that names none
    gets a fresh temporary folder; on a cluster a missing setting is an error,
    as every executor would write to its own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="statlake-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused sub folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
