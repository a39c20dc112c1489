"""Working tables in the shared checkpoint folder.

A written table cuts a plan's lineage: what follows reads files, so it is
planned from their sizes and survives lost executors.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ledgerflow.session import ensure_checkpoint_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under a fresh path and read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
