"""Partition layout helpers.

A table written as one large row group scans as one partition, and a
CPU-heavy step above it (the regex parse, gram explosion) would then run in
one task. ``spread`` adds a round-robin repartition where there are fewer
partitions than cores. The number of a scan's partitions does not tell where its
rows are: a file is cut into as many splits as its bytes ask for, but all rows of a
row group go to the split that holds its middle, and the others are empty.
``dealt`` therefore deals the rows out whatever the number is.
"""
from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` with at least ``min_partitions`` (default: the cluster's
    default parallelism) partitions. Round-robin repartitioning sorts rows
    inside each task first, so a retried task reproduces the same split."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` with its rows dealt out evenly, for narrow rows that a CPU-heavy step reads: over twice as many
    partitions as the scan has (they grow with its bytes) or the cluster has cores, at least the shuffle's."""
    spark = df.sparkSession
    n = max(2 * df.rdd.getNumPartitions(), 2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n)
