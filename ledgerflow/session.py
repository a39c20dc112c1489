"""Spark session settings shared by jobs, tests and the bench.

Cluster jobs get their session from the platform; ``configure`` only fills in
settings that are unset, so a cluster's own values (shuffle partitions,
checkpoint directory) always win.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC is required for periods and parse dates;
# ANSI stays on, so parsing uses the try_ forms.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Broadcast only below these sizes; larger sides take a shuffle join. Before a query runs, Spark has file
# sizes alone: a column or two of compressed keys, from which names, codes and phones are derived, grow to
# fifty times as much in a hash table, which the driver builds, and a query has ten or more joins. So little
# is broadcast by file size, and the rest by the size of the rows once they are shuffled.
BROADCAST_FILE_BYTES = 256 * 1024
BROADCAST_ROW_BYTES = 8 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    conf = spark.conf
    for key, value in REQUIRED.items():
        conf.set(key, value)
    if conf.get("spark.sql.autoBroadcastJoinThreshold", None) in (None, ""):
        conf.set("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_FILE_BYTES))
        conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_ROW_BYTES))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerflow") -> SparkSession:
    """Local session for tests and the bench (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as given. Only local runs (tests, bench) reach the fallback.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
