"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes DataFrames / Columns.  ``get_session`` is a convenience for tests, the
bench and command-line use; on a cluster, pass your own session.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quire") -> SparkSession:
    """A session for tests, the bench and local use.

    ``spark.sql.shuffle.partitions`` is set only when asked for: adaptive execution
    merges small partitions but never adds any, so a low figure would bind large runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set at most once per session.

    A folder already set is returned as it is (setting it again would nest a new
    folder each time).  Otherwise ``spark.checkpoint.dir`` is used; when that is unset
    a scratch folder is made on a ``local`` master only, since on a cluster the
    executors could not read a folder of the driver's machine.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path:
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[[^\]]*\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
