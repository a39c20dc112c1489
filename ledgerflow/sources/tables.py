"""Reading the input tables.

Every reader selects the columns it needs right at the scan, so Parquet
reads only those (``ReadSchema`` in the plan) and filters written after it
reach the scan as ``PushedFilters``.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df
