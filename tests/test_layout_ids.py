"""Dense ids stay consistent when cached; spread only adds parallelism."""
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import functions as F

from ledgerflow.operators.ids import dense_ids
from ledgerflow.operators.layout import spread
from ledgerflow.operators.parse import parse_messages
from ledgerflow.session import configure


def test_dense_ids_persisted_and_read_twice(spark):
    """A persisted id table read by both sides of a join (the case that once
    gave two rows one id) stays dense and unique, and follows the order."""
    base = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    ids = dense_ids(base, [F.col("k")], name="rid").persist(StorageLevel.MEMORY_AND_DISK)
    left = ids.select("k", F.col("rid").alias("a"))
    right = ids.select("k", F.col("rid").alias("b"))
    rows = left.join(right, "k").collect()
    assert len(rows) == 5000
    assert all(r.a == r.b == r.k + 1 for r in rows)
    ids.unpersist()


def test_spread(spark):
    one = spark.range(0, 100, numPartitions=1)
    target = spark.sparkContext.defaultParallelism
    assert spread(one).rdd.getNumPartitions() == max(target, 1)
    wide = spark.range(0, 100, numPartitions=target + 3)
    assert spread(wide) is wide
    assert sorted(r.id for r in spread(one).collect()) == list(range(100))


def test_derived_keys_are_not_broadcast_by_file_size(spark, tmp_path):
    """Files of a few bytes a row become rows of a hundred: neither side is a hash table that the driver builds."""
    new = spark.newSession()
    new.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    new.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    configure(new)
    pd.DataFrame({"k": range(400_000)}).to_parquet(tmp_path / "t.parquet")
    t = new.read.parquet(str(tmp_path / "t.parquet"))
    row = lambda n: t.select(F.col("k"), *[F.sha2((F.col("k") + i).cast("string"), 256).alias(f"{n}{i}") for i in range(2)])
    j = row("a").join(row("b"), "k")
    assert j.where("a0 = b0 and a1 = b1").select("a0", "b1").agg(F.count("*").alias("n"), F.max("b1")).collect()[0].n == 400_000
    ran = j.agg(F.max("a0"), F.max("a1"), F.max("b0"), F.max("b1"))
    ran.collect()
    assert "BroadcastHashJoin" not in ran._jdf.queryExecution().executedPlan().toString()


def test_parse_deals_out_a_row_group_cut_into_splits(spark, tmp_path):
    """All rows of a row group are in one of the splits of its file; the parse reads them in many tasks."""
    new = spark.newSession()
    new.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    new.conf.set("spark.sql.files.openCostInBytes", "1k")
    n = 20_000
    pd.DataFrame({"id": range(n), "raw_content": [f"emp {i * 7919 % 100003} 01700000000(B) {i}/-" for i in range(n)],
                  "timestamp_wa": pd.Timestamp("2026-01-01")}).to_parquet(tmp_path / "m.parquet", row_group_size=n)
    m = new.read.parquet(str(tmp_path / "m.parquet"))
    assert m.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert m.groupBy(F.spark_partition_id()).count().count() == 1
    parsed = parse_messages(m.withColumn("timestamp_wa", F.col("timestamp_wa").cast("timestamp")))
    per = [r[0] for r in parsed.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(per) == n and max(per) < n / 4
