"""Top-k rows per group without one task holding a whole hot group.

Phase 1 ranks inside (group, salt) buckets, so a group that holds a large
share of the rows is spread over ``salt_buckets`` tasks and each keeps at
most k rows; phase 2 ranks the at most ``salt_buckets * k`` survivors per
group. The result equals a plain ``row_number() <= k`` when ``order`` is a
total order (end it with a unique key).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALT_BUCKETS = 32


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                    salt_of: Column, salt_buckets: int = DEFAULT_SALT_BUCKETS,
                    rank_col: str | None = None) -> DataFrame:
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    first = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    name = rank_col or "_rank"
    out = first.withColumn(name, F.row_number().over(w2)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)
