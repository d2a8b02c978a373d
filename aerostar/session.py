"""Spark session defaults and the shared checkpoint folder.

Jobs never build their own session: callers pass one in.  ``local_session``
exists for tests, the bench and the smoke entry; on a cluster the platform's
session is used as is and only missing settings are filled in.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  They are applied with ``setdefault``
# semantics: a value the cluster already set wins.
JOB_DEFAULTS = {
    # Runtime re-planning: coalesces small shuffle partitions, converts a
    # sort-merge join to a broadcast join when the measured side is small,
    # and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Date arithmetic and the oracle comparison are pinned to UTC.
    "spark.sql.session.timeZone": "UTC",
    # ANSI stays on: division by zero and decimal overflow raise, so every
    # ratio in this package is written with try_divide / nullif.
    "spark.sql.ansi.enabled": "true",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in JOB_DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "aerostar", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no server).

    ``event_log_dir``: write Spark's event log there (stage and task metrics
    without a web UI).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("AEROSTAR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    for key, value in JOB_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a ``local`` master gets a fresh scratch folder; any
    other raises, so lineage cuts never land in a machine-local folder on a
    real cluster.  Works with a classic session (SparkContext) and with a
    Spark Connect session (configuration only).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        return path
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="aerostar-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
