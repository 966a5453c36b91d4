"""J7: media manifest and copy (SNK-4, SNK-10, SRC-6, SRC-11, SRC-13).

The manifest is a DataFrame (src_path, dest_path, content_type, length):
destination ``Video/<source>/<ingest day>/<ingest datetime>_<file name>``,
content type from the extension map. The copy streams each file from its
place to its destination on the executors; neither the driver nor a shuffle
sees a file's bytes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import base_name, extension, padded_date, padded_datetime
from ..functions.lookups import CONTENT_TYPE, DEFAULT_CONTENT_TYPE, lookup
from ..session import qualified, work_dir
from ..sources.objects import list_tree, opener

COPY_CHUNK = 8 << 20


def _ts(run_ts) -> Column:
    """The ingest time as a literal: every evaluation of a plan (the copy, a
    later read of the returned manifest) must name the same destination."""
    if run_ts is None:
        run_ts = datetime.now(timezone.utc)
    return F.lit(run_ts) if not isinstance(run_ts, Column) else run_ts


def media_dest(path: Column, source: str | Column, run_ts=None) -> Column:
    """SNK-4: ``Video/<source>/<yyyy-MM-dd>/<yyyy-MM-dd HH:mm:ss>_<base name>``."""
    ts = _ts(run_ts)
    src = F.lit(source) if isinstance(source, str) else source
    return F.concat(F.lit("Video/"), src, F.lit("/"), padded_date(ts), F.lit("/"),
                    padded_datetime(ts), F.lit("_"), base_name(path))


def manifest(files: DataFrame, source: str | Column, run_ts=None, path_col: str = "path",
             length_col: str | None = "length", identity: bool = False,
             keep: list[str] | None = None) -> DataFrame:
    """Manifest rows; ``identity=True`` keeps the name as is (plain upload, SNK-10).

    ``keep`` carries extra input columns (e.g. ``content``) along the projection.
    """
    path = F.col(path_col)
    dest = path if identity else media_dest(path, source, run_ts)
    length = F.col(length_col).cast("bigint") if length_col else F.lit(None).cast("bigint")
    return files.select(
        path.alias("src_path"),
        dest.alias("dest_path"),
        lookup(CONTENT_TYPE, extension(path), DEFAULT_CONTENT_TYPE).alias("content_type"),
        length.alias("length"),
        *[F.col(c) for c in (keep or [])],
    )


def list_objects(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """SRC-6: every object under ``root`` (path, length, modificationTime), listed in tasks; bytes are not read."""
    return list_tree(spark, root, glob)


def read_media(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """SRC-11: media objects as bytes (``path, length, content``), for objects that fit a row (below 2 GB)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "length", "content")


def copy_media(spark: SparkSession, src_root: str, dest_root: str, source: str, run_ts=None,
               glob: str | None = None) -> DataFrame:
    """Copy every media file to its manifest destination; returns the manifest.

    Files are listed without their bytes; :func:`copy_objects` streams them.
    """
    plan = manifest(list_objects(spark, src_root, glob), source, _ts(run_ts))
    return copy_objects(plan, dest_root)


def copy_objects(plan: DataFrame, dest_root: str) -> DataFrame:
    """Copy each row's ``src_path`` to ``<dest_root>/<dest_path>`` on the executors; returns the rows with ``copied`` bytes.

    Only names are shuffled. A task opens its objects one by one through ``pyarrow.fs``
    (local, HDFS and object-store URIs) and copies them in chunks, so an object of any
    size needs a constant amount of memory. A retried task writes the same bytes to the
    same name. The result is written once under the checkpoint folder: reading it does not copy again.
    """
    spark = plan.sparkSession
    root = qualified(spark, dest_root)
    schema = T.StructType([*plan.schema.fields, T.StructField("copied", T.LongType())])
    src, dest = plan.columns.index("src_path"), plan.columns.index("dest_path")
    chunk, opened = COPY_CHUNK, opener()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            sizes = []
            for a, z in zip(b.column(src).to_pylist(), b.column(dest).to_pylist(), strict=True):
                (from_fs, from_path), (to_fs, to_path) = opened(a), opened(f"{root}/{z}")
                to_fs.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
                n = 0
                with from_fs.open_input_stream(from_path) as i, to_fs.open_output_stream(to_path) as o:
                    while data := i.read(chunk):
                        o.write(data)
                        n += len(data)
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64())], [*b.schema.names, "copied"])

    done = work_dir(spark, "media-copied")
    plan.repartition(F.col("src_path")).mapInArrow(run, schema).write.parquet(done)
    return spark.read.schema(schema).parquet(done)
