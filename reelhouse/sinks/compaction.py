"""Compaction of an append-only Parquet table, with clustering (SNK-2, SET-1).

Each load leaves files of its own, so after many loads a table is many small files, and a lookup reads them all.
``compact`` rewrites the small files of a table (those below half the target) as files of about the target size and leaves the others alone. A task
sorts the rows of one file, so a file whose rows compress well also ends at `SORTED_BYTES` of rows in memory, and one that holds half of that is not small. The rewritten rows
are ordered by a space-filling curve over the clustering columns: each column's values are numbered by quantile (`STEPS` of
them) and the numbers' bits are interleaved, so a file covers a narrow range of every column, its Parquet statistics are narrow too, and a lookup
by any of the columns skips most files.

Files are chosen from the table's manifest and replaced by one commit (``sinks/manifest.py``): readers of the
manifest see the rows once, before, while and after it runs; a run that is lost changes nothing. Rows are range partitioned
by the curve and then by the columns, so one value that holds a third of the rows is spread over files by the other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import qualified, work_dir
from ..sources.objects import list_folders
from . import manifest

TARGET_BYTES = 256 << 20
#: Bytes of the rows of one file while they are sorted.
SORTED_BYTES = 512 << 20
#: Quantile steps of a clustering column: a power of two.
STEPS = 64
#: Bytes of a text that place it; texts are in byte order up to there.
PREFIX = 7


def _number(df: DataFrame, column: str) -> Column:
    """A value's place as a number or a time: itself, or for text the number that its first bytes make."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    head = F.substring(F.hex(F.encode(F.col(column), "UTF-8")), 1, 2 * PREFIX)
    return F.conv(F.rpad(head, 2 * PREFIX, "0"), 16, 10).cast("long")


def _step(value: Column, bounds: list) -> Column:
    """How many of the bounds are at or below the value."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= value))


def curve(df: DataFrame, columns: list[str]) -> Column:
    """The place of a row on the curve through the quantile steps of the columns; nulls are in the first step."""
    values = [_number(df, c) for c in columns]
    ranks = [i / STEPS for i in range(1, STEPS)]
    found = df.agg(*[F.percentile_approx(v, ranks, 10_000).alias(f"b{i}") for i, v in enumerate(values)]).first()      # STEPS values a column
    place = F.lit(0).cast("long")
    for i, v in enumerate(values):
        step = _step(v, sorted(set(found[i] or [])))
        for b in range(STEPS.bit_length() - 1):
            place = place + F.shiftleft(F.shiftright(step, b).bitwiseAND(F.lit(1)).cast("long"), b * len(columns) + i)
    return place


def files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(file, length) of the table's files that count."""
    lies = list_folders(spark.createDataFrame([(table,)], "folder string"), root).where("NOT is_folder").select(F.col("name").alias("file"), "length")
    return lies.join(manifest.current(spark, root, table), "file", "left_semi")


def _width(df: DataFrame) -> Column:
    """Bytes of a row in a sort: a word for the nulls, three for its place, one for each value, and what texts and nested values hold (these as JSON)."""
    width = F.lit(8 * (4 + len(df.columns))).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + 7
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return width


def compact(spark: SparkSession, root: str, table: str, cluster_by: list[str], target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite the table's files below half of ``target_bytes``; returns how many were replaced (0: nothing to do)."""
    base = f"{qualified(spark, root)}/{table}"
    change = manifest.Change(spark, root, [table])
    small = files(spark, root, table).where(F.col("length") < target_bytes // 2)
    names = [f"{base}/{r.file}" for r in small.select("file").collect()]            # Spark's own file index holds as many
    if len(names) < 2:
        change.abandon()
        return 0
    # Files of many rows are full, however few bytes they take.
    rows = spark.read.parquet(*names)
    path = work_dir(spark, "compaction-files")
    (rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.sum(_width(rows)).alias("width"))
     .join(small, "file", "right").select("file", "length", F.coalesce("width", F.lit(0)).cast("bigint").alias("width")).write.parquet(path))
    small = spark.read.schema("file string, length bigint, width bigint").parquet(path).where(F.col("width") < SORTED_BYTES // 2)
    count, size, width = small.agg(F.count(F.lit(1)), F.sum("length"), F.sum("width")).first()
    if count < 2:
        change.abandon()
        return 0
    rows = spark.read.parquet(*[f"{base}/{r.file}" for r in small.select("file").collect()])
    change.drop(table, small.select("file"))
    parts = max(1, -(-size // target_bytes), -(-width // SORTED_BYTES))
    placed = rows.withColumn("_place", curve(rows, cluster_by))
    ordered = placed.repartitionByRange(parts, "_place", *cluster_by).sortWithinPartitions("_place", *cluster_by)
    ordered.drop("_place").write.mode("append").parquet(base)
    change.commit()
    return count
