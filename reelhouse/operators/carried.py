"""A log in key and time order over many tasks, with values carried along each key across task borders.

Window functions partitioned by the key put a key that holds a third of all rows into one task. Here the log is
range partitioned by (key, time, tie) and written once with its partition number (``shard``); windows run over
(shard, key), so such a key is spread by time. What a window misses is what earlier partitions held of its key, and that concerns a
partition's first key only: the keys in between lie in one partition. ``carried_max`` gives it, as one row for each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import work_dir


def ranged(log: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """``log`` in range partitions of ``key`` (without null keys) and ``order``, written once, with a column ``shard``."""
    path = work_dir(log.sparkSession, "ranged-log")
    spread = log.where(F.col(key).isNotNull()).repartitionByRange(key, *order).withColumn("shard", F.spark_partition_id())
    spread.write.parquet(path)
    return log.sparkSession.read.schema(spread.schema).parquet(path)


def carried_max(log: DataFrame, key: str, value: Column) -> DataFrame:
    """(c_shard, c_key, carried): for each shard's first key, the greatest ``value`` that earlier shards hold of it, if any."""
    each = log.groupBy("shard", F.col(key).alias("k")).agg(F.max(value).alias("v"))
    ends = each.groupBy("shard").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.max_by("v", "k").alias("v"))
    out = ends.select("shard", F.lit(1).alias("way"), F.col("last").alias("k"), "v")
    into = ends.select("shard", F.lit(0).alias("way"), F.col("first").alias("k"), F.lit(None).cast(each.schema["v"].dataType).alias("v"))
    before = W.partitionBy("k").orderBy("shard", "way").rowsBetween(W.unboundedPreceding, -1)          # one or two rows a shard
    found = out.unionByName(into).withColumn("carried", F.max("v").over(before)).where("way = 0 AND carried IS NOT NULL")
    return found.select(F.col("shard").alias("c_shard"), F.col("k").alias("c_key"), "carried")


def with_carried(log: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """``log`` with a column ``name``: `carried_max` of its shard and key, or null. One row for each shard is broadcast."""
    found = carried_max(log, key, value).withColumnRenamed("carried", name)
    return log.join(F.broadcast(found), (F.col("shard") == F.col("c_shard")) & (F.col(key) == F.col("c_key")), "left").drop("c_shard", "c_key")
