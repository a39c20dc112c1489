"""Dense surrogate ids in a stated order without a single-task window.

A global ``row_number()`` runs in one task. Here the rows are range-sorted
across partitions, each row gets its position inside its partition from
``monotonically_increasing_id`` (partition index in the upper bits), and a
per-partition offset table (one row per partition, so its size is bounded by
the partition count and safe to broadcast) turns that into a dense id.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = 33


def dense_ids(df: DataFrame, order: list[Column | str], start: Column | int = 0,
              name: str = "id") -> DataFrame:
    """Add ``name`` = start + 1, start + 2, ... following ``order``.

    ``order`` must be a total order (end it with a unique key), so a retried
    task recomputes the same positions.

    The sorted rows are read twice (per-partition counts and the rows), and
    both reads must see the same partitioning. Within one plan the sort's
    exchange is reused, but when the result is cached (as a persisted input
    of a later join) the two reads were planned apart and could split the
    range differently, giving the same id to different rows. The sorted,
    position-tagged rows are therefore persisted once and read by both.
    """
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    ordered = (ordered.withColumn("_part", F.shiftright("_mid", _LOW_BITS))
               .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    out = ordered.join(F.broadcast(offsets), "_part")
    return out.withColumn(name, (start_col + F.col("_off") + F.col("_pos") + 1).cast("long")) \
              .drop("_mid", "_part", "_pos", "_off")
