"""Session helpers.

On a cluster the driver program owns the ``SparkSession``; this module only
builds one for tests and the bench, and fills in settings that are unset.
One is always set: the time zone, as timestamps are naive wall-clock values.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "bankscope") -> SparkSession:
    """A local session for tests/bench: UI off, UTC, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
        # nothing reads the status store of a local test/bench session: keep it
        # small so it does not grow with every job of a long run
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "100")
        .config("spark.ui.retainedTasks", "2000")
        .config("spark.sql.ui.retainedExecutions", "20")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_settings(spark)
    return spark


def ensure_settings(spark: SparkSession) -> None:
    """Set session-level defaults only where the cluster left them unset."""
    conf = spark.conf
    for k, v in _DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    # Timestamps are naive wall-clock values: always evaluate in UTC.
    conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's ``spark.checkpoint.dir``.

    Only a local session (tests, the bench) may go without: then a scratch
    folder is created and registered.  On a cluster each executor would write
    to a disk of its own, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="bankscope-ckpt-", dir=os.environ.get("BANKSCOPE_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
