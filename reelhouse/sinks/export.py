"""J8: any Spark SQL query -> CSV parts of an exact row count (H2).

Plan, with no step that pulls rows through one task or the driver:

1. optional ``repartitionByRange`` + ``sortWithinPartitions`` on the caller's
   order keys (Spark rows have no order otherwise);
2. the ordered rows are written once as a Parquet table under
   ``spark.checkpoint.dir`` together with their partition id and position
   inside the partition (``monotonically_increasing_id`` carries it in its
   low 33 bits), so the counting pass and the writing pass read the very
   same numbering even if executors are lost in between (an unpersisted or
   merely cached input can be recomputed differently);
3. rows per partition (reading only the partition-id column; one tiny
   aggregate row per partition), prefix sum by a window over that tiny
   table, broadcast back (its size is the partition count);
4. global row number = offset + position inside the partition,
   ``part = (rn - 1) div N + 1``;
5. rows become CSV lines and every part gets a header line as its row 0;
   ``repartition(parts, part)``: every part lands in exactly one task, so
   each part directory holds one file; files are renamed to
   ``<stem>-part<k>.csv`` (``<stem>.csv`` when there is a single part).

Columns are carried by position (``c0``, ``c1``, ...) and the caller's names are
restored in the header line, so names may repeat or equal any name used here.

CSV dialect: header in every part, comma, ``\\n``, minimal quoting with
doubled quotes, empty text and null both written as nothing, no trimming.
Date and time columns are rendered as ``yyyy-MM-dd HH:mm:ss`` text.
"""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import csv_stem, padded_datetime
from ..session import remove_path, work_dir

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
    "encoding": "UTF-8",
}
_DATETIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
#: Rows that one writing task takes, of as many whole parts as fit (one at least).
ROWS_PER_TASK = 100_000


def render_datetimes(df: DataFrame) -> DataFrame:
    """UDF-3 / FN-14: date and time columns become text (type-driven projection)."""
    cols = [
        padded_datetime(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, _DATETIME_TYPES) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def header_case(df: DataFrame, case: str = "upper") -> DataFrame:
    """SNK-8 / FN-13: column names upper, lower or unchanged."""
    if case == "upper":
        return df.toDF(*[c.upper() for c in df.columns])
    if case == "lower":
        return df.toDF(*[c.lower() for c in df.columns])
    return df


def part_file_name(stem: str, part: int, n_parts: int) -> str:
    """SNK-7: ``<stem>-part<k>.csv``, or ``<stem>.csv`` for a single part."""
    return f"{stem}.csv" if n_parts <= 1 else f"{stem}-part{part}.csv"


def part_size(rows_per_part: int, batch_rows: int | None = None) -> int:
    """Rows per part; with ``batch_rows`` rounded up to whole fetch batches."""
    if rows_per_part <= 0:
        raise ValueError("rows_per_part must be positive")
    if batch_rows:
        return batch_rows * -(-rows_per_part // batch_rows)
    return rows_per_part


def number_rows(df: DataFrame, rows_per_part: int, order_by: list[str] | None = None,
                num_partitions: int | None = None, batch_rows: int | None = None,
                stage_path: str | None = None) -> tuple[DataFrame, int]:
    """Adds ``_rn`` (1-based global row number) and ``part``; returns (df, total rows).

    The ordered rows are written once as a Parquet table under the shared
    checkpoint folder, with their task (``_pid``) and position in the task
    (``_local``) as columns. Both passes that follow (counting, writing)
    read that table, so they see identical numbering even if executors are
    lost; counting reads only the ``_pid`` column.

    ``batch_rows`` reproduces the original fetch-batch rounding: a part
    then holds ``batch_rows * ceil(rows_per_part / batch_rows)`` rows.
    """
    rows_per_part = part_size(rows_per_part, batch_rows)
    reserved = {"_rn", "part", "_pid", "_local", "_offset"} & {c.lower() for c in df.columns}
    if reserved:
        raise ValueError(f"columns {sorted(reserved)} clash with the numbering; rename them (export_csv carries columns by position)")
    spark = df.sparkSession
    staged = df
    if order_by:
        # Rows with equal order keys are spread by a hash of the row: a key value
        # holding a third of all rows must not become one range partition (ties
        # have no defined order, so this keeps the requested ordering).
        hashable = [F.col(f"`{f.name}`") for f in df.schema.fields
                    if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        keys = [F.col(c) for c in order_by] + ([F.xxhash64(*hashable)] if hashable else [])
        # Without an explicit count Spark uses spark.sql.shuffle.partitions and AQE
        # coalesces adjacent ranges (order is kept); the numbering below reads the
        # partitions as they finally are.
        ranged = staged.repartitionByRange(num_partitions, *keys) if num_partitions else staged.repartitionByRange(*keys)
        staged = ranged.sortWithinPartitions(*keys)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    path = stage_path or work_dir(spark, "export-stage")
    staged.select("*", pid.alias("_pid"), local.alias("_local")).write.parquet(path)
    staged = spark.read.parquet(path)
    # One row per task. Not cached: recomputing it reads only the small _pid column.
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_offset"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    numbered = (staged.join(F.broadcast(offsets), "_pid")
                .withColumn("_rn", F.col("_offset") + F.col("_local") + 1)
                .withColumn("part", F.expr(f"(_rn - 1) div {int(rows_per_part)}") + 1)   # integer division
                .drop("_pid", "_local", "_offset"))
    return numbered, int(total)


@dataclass
class ExportResult:
    files: list[str]
    n_rows: int
    n_parts: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _header_line(names: list[str]) -> str:
    """One CSV line of column names, quoted as the data is; repeated and odd names are fine."""
    text = io.StringIO()
    csv.writer(text, lineterminator="").writerow(names)
    return text.getvalue()


def _positions(names: list[str], order_by: list[str]) -> list[str]:
    """The positional names (c0, c1, ...) of the order keys; an exact name wins over other cases of it."""
    out = []
    for key in order_by:
        at = [i for i, n in enumerate(names) if n == key] or [i for i, n in enumerate(names) if n.lower() == key.lower()]
        if len(at) != 1:
            raise ValueError(f"order key {key!r} names {len(at)} columns")
        out.append(f"c{at[0]}")
    return out


def csv_lines(df: DataFrame) -> Column:
    """Each row as a CSV line. A line of one empty or null value is ``""``, as an empty line would be no row."""
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "lineSep", "encoding")})
    if len(df.columns) > 1:
        return line
    return F.when(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit("")) == "", '""').otherwise(line)


def export_csv(df: DataFrame, out_dir: str, file_name: str, rows_per_part: int = 500_000,
               order_by: list[str] | None = None, case: str = "upper", split: bool = True,
               batch_rows: int | None = None, num_partitions: int | None = None) -> ExportResult:
    """SNK-5..8: write ``df`` as CSV parts of exactly ``rows_per_part`` rows.

    Data columns are carried by position, so a query may use any column names, repeated ones too.
    """
    spark = df.sparkSession
    names = df.columns
    header = [n.upper() if case == "upper" else n.lower() if case == "lower" else n for n in names]
    data = render_datetimes(df.toDF(*[f"c{i}" for i in range(len(names))]))
    stem = file_name[:-4] if file_name.endswith(".csv") else file_name
    staging = f"{out_dir.rstrip('/')}/_staging_{stem}"
    rows_per_part = part_size(rows_per_part, batch_rows) if split else 1 << 62
    stage = work_dir(spark, "export-stage")
    numbered, total = number_rows(data, rows_per_part, _positions(names, order_by) if order_by else None, num_partitions, stage_path=stage)
    n_parts = max(1, -(-total // rows_per_part))
    lines = numbered.select("part", "_rn", csv_lines(data).alias("value"))
    headers = spark.range(1, n_parts + 1).select(F.col("id").alias("part"), F.lit(0).cast("bigint").alias("_rn"),
                                                 F.lit(_header_line(header)).alias("value"))
    # Each part in exactly one task. Tasks grow with the rows, so a task's share stays the
    # same at any size; parts of few rows share a task.
    tasks = min(n_parts, max(spark.sparkContext.defaultParallelism, -(-total // ROWS_PER_TASK)))
    (lines.unionByName(headers).repartition(tasks, "part").sortWithinPartitions("part", "_rn").select("part", "value")
     .write.mode("overwrite").option("lineSep", CSV_OPTIONS["lineSep"]).partitionBy("part").text(staging))
    fs, _, jvm = _fs(spark, staging)

    def place(k: int) -> str:
        src_dir = jvm.org.apache.hadoop.fs.Path(f"{staging}/part={k}")
        srcs = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")]
        if len(srcs) != 1:
            raise RuntimeError(f"part {k}: expected one file, found {len(srcs)}")
        dest = jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/{part_file_name(stem, k, n_parts)}")
        if fs.exists(dest):
            fs.delete(dest, False)
        fs.rename(srcs[0], dest)
        return dest.toString()

    with ThreadPoolExecutor(max_workers=16) as pool:     # renames wait on the store, not on this process
        files = list(pool.map(place, range(1, n_parts + 1)))
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    remove_path(spark, stage)   # the numbered staging table has no reader left
    return ExportResult(files=files, n_rows=total, n_parts=n_parts)


def export_sql(spark: SparkSession, sql: str, out_dir: str, file_name: str, args: dict | None = None,
               **kwargs) -> ExportResult:
    """SQL-1 + SNK-5: column names come from the analysed plan, the query runs once."""
    return export_csv(spark.sql(sql, args=args), out_dir, file_name, **kwargs)


def part_counts(numbered: DataFrame) -> DataFrame:
    """AGG-3: rows per part and the grand total (``part`` null) via rollup."""
    return numbered.rollup("part").agg(F.count(F.lit(1)).alias("n_rows"))


def file_names(parts: DataFrame, stem: str) -> DataFrame:
    """SNK-7 / FN-17 as a column: file name per part given the part count."""
    n = F.max("part").over(Window.partitionBy(F.lit(1)))
    stem_col = csv_stem(F.lit(stem + ".csv"))
    return parts.withColumn(
        "file_name",
        F.when(n <= 1, F.concat(stem_col, F.lit(".csv")))
        .otherwise(F.concat(stem_col, F.lit("-part"), F.col("part").cast("string"), F.lit(".csv"))),
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.options(**{k: v for k, v in CSV_OPTIONS.items() if k != "lineSep"}).option("multiLine", "true")
    return (r.schema(schema) if schema is not None else r).csv(path)
