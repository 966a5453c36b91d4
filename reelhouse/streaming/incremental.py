"""J4: incremental load with Structured Streaming (STR-1, STR-2).

The daily "list the folder an hour later" hand-over becomes a file-source
stream over the landing folder, ``.json`` files only, a checkpoint in the
shared checkpoint folder and ``availableNow``: each run processes exactly
the files not seen before and stops, so a second run with no new file
appends nothing (unlike the batch append, which re-appends).

Every micro-batch writes one folder ``load_batch=<stream>-<batch id>`` of the
target table, in overwrite mode: a batch that is retried after a lost driver
or executor replaces its own rows and touches no others. The row count a run
returns is counted by the writing job itself.

``load_new_records`` is the strict load: files are read as text and every
line is checked as in the batch load (a file is always in one micro-batch as
a whole). A record (``_record``, day) is taken once, whatever the order in
which days arrive: the batch is anti-joined with the target's keys, of which
only the batch's own days are read. There is no watermark and no state.

``load_new_files`` appends typed files as they are; skipping what is already
stored (STR-2) is a keyed de-duplication, in the stream's state
(``dropDuplicates``) or against the keys the target holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.landing import DAY_COL, RECORD
from ..sinks.warehouse import failed_files, line_checks, load_report, typed_columns

BATCH_COL = "load_batch"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                glob: str | None = "*.json", max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def with_day_column(schema: T.StructType) -> T.StructType:
    if DAY_COL in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(DAY_COL, T.StringType(), True)])


def _run(stream: DataFrame, table_path: str, checkpoint: str, batch_rows: Callable[[DataFrame, str], DataFrame],
         partition_by: list[str] | None) -> int:
    """Process all new files; each batch overwrites its own folder. Returns the rows written."""
    name = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    written: list[int] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        label = f"{name}-{epoch_id}"
        seen = Observation()
        w = batch_rows(batch, label).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{table_path.rstrip('/')}/{BATCH_COL}={label}")
        written.append(seen.get["n"])

    q = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(write).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sum(written)


def _stored(spark: SparkSession, table_path: str, schema: T.StructType, label: str) -> DataFrame:
    """The target's rows of all other batches (none before the first)."""
    full = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.StringType())])
    return spark.read.schema(full).parquet(table_path).where(F.col(BATCH_COL) != label)


def load_new_files(spark: SparkSession, src: str, schema: T.StructType, table_path: str, checkpoint: str,
                   dedup_keys: list[str] | None = None, fmt: str = "json", glob: str | None = "*.json",
                   partition_by: list[str] | None = None, dedup_mode: str = "state",
                   transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Append the rows of files not seen before; returns the rows written this run.

    ``dedup_keys`` turns on STR-2: a key already appended in any earlier run
    (or earlier in this run) is skipped. ``dedup_mode="state"`` keeps the
    seen keys in the stream's state store, which grows with the keys;
    ``"target"`` keeps no state and anti-joins each micro-batch against the
    key columns of the target table; with ``partition_by`` columns that belong to the key (a row's
    day), only the partitions that the batch's rows fall into are read, so neither state nor reads grow with
    the table, however late a row is. The table has one more column, ``load_batch``.
    """
    if dedup_mode not in ("state", "target"):
        raise ValueError(f"unknown dedup_mode {dedup_mode!r}")
    own = [c for c in partition_by or [] if c in (dedup_keys or [])]
    stream = file_stream(spark, src, schema, fmt, glob)
    if transform is not None:
        stream = transform(stream)
    if dedup_keys and dedup_mode == "state":
        stream = stream.dropDuplicates(dedup_keys)
    stored_schema = stream.schema

    def fresh(batch: DataFrame, label: str) -> DataFrame:
        if not dedup_keys or dedup_mode == "state":
            return batch
        keys = T.StructType([f for f in stored_schema.fields if f.name in dedup_keys])
        s = batch.sparkSession
        _ensure(s, table_path)
        stored = _stored(s, table_path, keys, label)
        for c in own:
            values = [r[0] for r in batch.select(c).distinct().collect()]          # the partitions of one batch
            stored = stored.where(F.col(c).isin([v for v in values if v is not None]) | F.lit(None in values) & F.col(c).isNull())
        batch = batch.dropDuplicates(dedup_keys)
        return _null_safe_anti(batch, stored.select(*dedup_keys), dedup_keys)

    return _run(stream, table_path, checkpoint, fresh, partition_by)


def _null_safe_anti(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are not stored; null keys equal null keys, as they do in ``dropDuplicates``."""
    other = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(other[f"_stored_{k}"])
    return rows.join(other, same, "left_anti")


def _ensure(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def load_new_records(spark: SparkSession, src: str, schema: T.StructType, table_path: str, checkpoint: str) -> int:
    """Strict incremental load of landed records; returns the rows written this run.

    Bad files load nothing and are reported, with the good ones, in
    ``<table_path>_load_report``. The table holds the schema's columns, the
    day, ``_record`` and ``load_batch``. Rows without ``_record`` have no
    identity and are all taken. Of a record that occurs in several new files
    the latest file's row is taken.
    """
    wire = T.StructType([T.StructField("value", T.StringType()), T.StructField(DAY_COL, T.StringType())])
    meta = F.col("_metadata")
    lines = file_stream(spark, src, wire, "text").select(
        "value", DAY_COL, meta["file_path"].alias("file_path"), meta["file_name"].alias("file_name"),
        meta["file_modification_time"].alias("file_time")).where(F.length(F.trim("value")) > 0)
    report_path = f"{table_path.rstrip('/')}_load_report"
    keys = T.StructType([T.StructField(RECORD, T.StringType()), T.StructField(DAY_COL, T.StringType())])

    def fresh(batch: DataFrame, label: str) -> DataFrame:
        s = batch.sparkSession
        checked = line_checks(batch, schema)
        report_dir = f"{report_path}/{BATCH_COL}={label}"
        load_report(checked, DAY_COL).write.mode("overwrite").parquet(report_dir)
        report = s.read.parquet(report_dir)
        days = [r[DAY_COL] for r in report.select(DAY_COL).distinct().collect()]     # one value for each landed day
        good = failed_files(checked, report).select(
            F.struct(*typed_columns(schema)).alias("row"), F.try_variant_get("v", f"$.{RECORD}", "string").alias(RECORD), DAY_COL,
            F.struct("file_time", "file_path", "value").alias("version"))
        named = good.where(F.col(RECORD).isNotNull()).groupBy(RECORD, DAY_COL).agg(F.max_by("row", "version").alias("row"))
        _ensure(s, table_path)
        stored = _stored(s, table_path, keys, label).where(F.col(DAY_COL).isin(*days)).select(RECORD, DAY_COL)
        named = named.join(stored, [RECORD, DAY_COL], "left_anti")
        return named.unionByName(good.where(F.col(RECORD).isNull()).drop("version")).select("row.*", RECORD, DAY_COL)

    return _run(lines, table_path, checkpoint, fresh, [DAY_COL])
