"""Spark session and shared work folder.

The session settings are the ones a pricing job wants on any cluster: UTC
time zone (dates are compared across engines), adaptive execution with skew
handling, and Arrow for the few pandas UDFs.  Nothing here hard-codes a
cluster path: intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``; only a local-mode session (tests) gets its own.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "resale") -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("RESALE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and checkpoints.

    Uses the checkpoint folder the cluster configured.  Only when it is unset
    and the session runs in local mode (tests, laptop) a private folder is
    created; on a cluster an unset folder is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="resale-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for intermediate tables")
    return sc.getCheckpointDir()
