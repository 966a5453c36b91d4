"""As-of join: each event with the latest observation of its key at or before its time.

Events and observations are one log in key and time order over many tasks (``operators/carried.py``). In each
task the last observation is carried along each key by a window, and across task borders by one row for each task, so
a key that holds a third of all rows is spread by time. The result is the same for any number of tasks.

Times may tie: an observation at an event's own time counts, and of several at one time the one with the greatest
value columns. Events without a key or a time, or without an earlier observation, get nulls. Observations without a key or a time never
count. Repeated events are kept. Empty inputs are fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .carried import ranged, with_carried


def asof_join(events: DataFrame, observations: DataFrame, key: str, time: str, values: list[str], prefix: str = "obs_") -> DataFrame:
    """``events`` with ``prefix`` + ``time`` and ``prefix`` + each of ``values`` of the observation that holds at their time."""
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    seen = F.struct(F.col(time), *values)
    log = (observations.where(known).select(F.col(key).alias("k"), F.col(time).alias("t"), seen.alias("seen"))
           .groupBy("k", "t").agg(F.max("seen").alias("seen"))          # of one time, one: combined before the shuffle
           .withColumn("side", F.lit(0)))
    asked = events.where(known).select(F.col(key).alias("k"), F.col(time).alias("t"), F.lit(1).alias("side"), F.struct("*").alias("event"))
    # An event's own content breaks ties of key and time, so that these are spread too.
    both = ranged(log.unionByName(asked, allowMissingColumns=True), "k", "t", "side", F.xxhash64("event"))
    both = with_carried(both, "k", F.col("seen"), "carried")           # the latest, as the struct begins with the time
    so_far = W.partitionBy("shard", "k").orderBy("t", "side").rowsBetween(W.unboundedPreceding, W.currentRow)
    held = both.withColumn("held", F.coalesce(F.last("seen", ignorenulls=True).over(so_far), "carried")).where("side = 1")
    found = held.select("event.*", *(F.col("held")[c].alias(f"{prefix}{c}") for c in [time, *values]))
    return found.unionByName(events.where(~known), allowMissingColumns=True)
