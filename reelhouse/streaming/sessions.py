"""Sessions of a key's rows: batch, and kept up to date from a file stream with late rows (event time, any arrival order).

A session is a run of a key's rows whose times are at most ``gap`` apart. A partial session is an interval with its
counts; folding overlapping or near ones (``fold``) is associative, so sessions of new rows and the sessions in the
target fold to those of all rows, whatever came first. A late row may extend, join or start sessions of any age.

``fold`` works on the log in key and time order over many tasks (``operators/carried.py``): a key, or a
session, that holds a third of all rows is spread by time and combined map-side.

``load_sessions`` runs a file stream (``availableNow``) into a table of ``BUCKETS`` folders by a hash of the key. A micro-batch rewrites the buckets of its
keys and makes the new files count, together with the batch's own mark, by one commit of the table's manifest. A batch that is retried after
a lost driver finds its mark, or starts again from the old state; readers never see half of it. The stream holds no state and drops no row.

Rows without a key or a time belong to no session. Empty inputs give no sessions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.carried import ranged, with_carried
from ..sinks import manifest
from .incremental import file_stream

BUCKETS = 32
BUCKET = "bucket"


def partial(rows: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Each row as a session of its own: (key, first, last, n, total)."""
    number = F.coalesce(F.col(value).cast("decimal(38,6)"), F.lit(0))
    return rows.where(F.col(time).isNotNull()).select(F.col(key).alias("key"), F.col(time).alias("first"), F.col(time).alias("last"), F.lit(1).cast("long").alias("n"),
                                                      number.cast("decimal(38,6)").alias("total"))


def fold(parts: DataFrame, gap: str) -> DataFrame:
    """Sessions (key, first, last, n, total) of partial ones; ``gap`` is a SQL interval, as ``30 minutes``."""
    same = parts.groupBy("key", "first", "last").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"))     # combined before the shuffle
    log = with_carried(ranged(same, "key", "first", "last"), "key", F.col("last"), "came")
    before = W.partitionBy("shard", "key").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1)
    until = F.greatest(F.max("last").over(before), "came")            # the latest row of the key so far
    opens = until.isNull() | (F.col("first") > until + F.expr(f"INTERVAL {gap}"))
    log = log.withColumn("opens", F.when(opens, F.col("first"))).drop("came")
    log = with_carried(log, "key", F.col("opens"), "open")
    so_far = W.partitionBy("shard", "key").orderBy("first", "last").rowsBetween(W.unboundedPreceding, W.currentRow)
    named = log.withColumn("session", F.coalesce(F.max("opens").over(so_far), "open"))
    return named.groupBy("key", F.col("session").alias("first")).agg(F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"))


def sessions(rows: DataFrame, key: str, time: str, value: str, gap: str) -> DataFrame:
    """(key, first, last, n, total) of all sessions of ``rows``; ``total`` sums ``value``, nulls as 0."""
    return fold(partial(rows, key, time, value), gap)


def read_sessions(spark: SparkSession, table: str, schema: T.StructType | str, buckets: list[int] | None = None) -> DataFrame:
    """The sessions that the table's manifest counts."""
    at = manifest.entries(spark, table).where(F.col("file").isNotNull() & F.col("folder").startswith(BUCKET + "="))
    if buckets is not None:
        at = at.where(F.col("folder").isin([f"{BUCKET}={b}" for b in buckets]))
    names = [f"{table.rstrip('/')}/{r.folder}/{r.file}" for r in at.collect()]           # a few files for each bucket
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def load_sessions(spark: SparkSession, src: str, schema: T.StructType, table: str, checkpoint: str, key: str, time: str, value: str, gap: str,
                  fmt: str = "json", glob: str | None = "*.json", max_files_per_trigger: int | None = None) -> None:
    """Fold the rows of files not seen before into the session table."""
    name = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]

    def write(batch: DataFrame, epoch: int) -> None:
        s, mark = batch.sparkSession, f"{name}-{epoch}"
        if manifest.marked(s, table, mark):
            return
        bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")
        parts = partial(batch, key, time, value)
        new = parts.groupBy("key", "first", "last").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,6)").alias("total"))
        touched = [r.b for r in new.where("key IS NOT NULL").select(bucket.alias("b")).distinct().collect()]          # at most BUCKETS numbers
        if not touched:
            return
        change = manifest.Change(s, table, [f"{BUCKET}={b}" for b in touched])
        after = fold(read_sessions(s, table, new.schema, touched).unionByName(new), gap)
        change.drop_all()
        after.withColumn(BUCKET, bucket).repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(table)
        change.commit(mark)

    q = (file_stream(spark, src, schema, fmt, glob, max_files_per_trigger).writeStream.option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(write).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
