"""Small helpers shared by the operators: staging, byte-balanced Arrow slices, hot keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.session import work_dir

#: Text handed to a kernel at once; an Arrow batch with more text is cut into slices of it.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a narrow table that one writing task takes, where the number of rows is known.
ROWS_PER_TASK = 200_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    ``rows``, a known bound of its rows, keeps a small narrow table from becoming many files: the
    last step then runs in one task for each `ROWS_PER_TASK` rows, so tasks grow with the table.

    Cuts lineage: a lost executor costs a re-read of the table, and values that depend on
    the partitioning (row ids, partition ids) are fixed from here on.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(text: Column | str) -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def byte_lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut each Arrow batch into zero-copy slices of about ``limit`` bytes of ``column``.

    A single longer value is a slice of its own. Row counts say little when texts run from
    nothing to megabytes, so the kernels' memory is bounded by bytes.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = byte_lengths(batch.column(column))
        if size.sum() <= limit:
            yield batch
            continue
        group = (np.cumsum(size) - size) // limit
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(size)], strict=True):
            yield batch.slice(int(a), int(b - a))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sampled_ids(rows: DataFrame, group: str, id_col: str, limit: int) -> DataFrame:
    """(group, id, rank): at most ``limit`` ids of each group, by a hash of the id; ranks begin at 1.

    ``rows`` has few groups (labels, languages). Their sizes are counted first, with map-side combining;
    a hash threshold then lets through little more than ``limit`` ids of a group, so that however many rows
    a group has, the ranking sees a bounded number.
    """
    sizes = {r[group]: r["count"] for r in rows.groupBy(group).count().collect()}
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 32))
    if not sizes:
        return rows.select(group, id_col, F.lit(0).alias("rank")).limit(0)
    shares = [(value, int((1 << 32) * min(1.0, (1.1 * limit + 100) / n))) for value, n in sizes.items() if value is not None]
    share = rows.sparkSession.createDataFrame(shares, T.StructType([T.StructField(group, rows.schema[group].dataType), T.StructField("_share", T.LongType())]))
    let = rows.join(F.broadcast(share), group).filter(place < F.col("_share")).select(group, id_col).distinct()     # a row for each group
    ranked = W.partitionBy(group).orderBy(place, id_col)
    return let.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= limit)
