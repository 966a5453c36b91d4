"""J2 landing: entity rows -> JSON under ``Metadata/<Entity>/ingest_date=<y-M-d>/``.

The day value is kept unpadded (``2023-6-4``, H5) and stored as a string
partition, so ``2023-6-1`` never matches ``2023-6-14``. Writes use dynamic
partition overwrite: re-landing a day replaces that day only. Merges into a day go through
a manifest (``sinks/manifest.py``), which makes them atomic. The logical
per-record file name of the original layout
(``<day>_metadata_<Entity>_<key>_<n>.json``) is kept as a column; one file
per record is not reproduced (it would be millions of tiny files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import dash_date
from ..functions.lookups import FOLDER
from ..session import path_exists, work_dir
from . import manifest

DAY_COL = "ingest_date"
# Landing-format field: the per-record key of the original one-file-per-record
# layout (``<video id>_<n>``). The strict loader knows it and drops it.
RECORD = "_record"
LANDING_FIELDS = (RECORD,)
# Full microsecond precision on the wire (the JSON default keeps milliseconds).
JSON_WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "writeNonAsciiCharacterAsCodePoint": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def day_text(day) -> str:
    """Unpadded ``Y-M-D`` text for a date / datetime / text value (padded text is accepted)."""
    if isinstance(day, str):
        parts = day.split("-")
        if len(parts) != 3 or not all(p.isascii() and p.isdigit() for p in parts):
            raise ValueError(f"not a day (Y-M-D): {day!r}")
        return "-".join(str(int(p)) for p in parts)
    return f"{day.year}-{day.month}-{day.day}"


def today_text(spark) -> str:
    """Today's unpadded day in the session time zone (one value for the whole run)."""
    return spark.range(1).select(dash_date(F.current_date())).first()[0]


def entity_dir(base: str, entity: str) -> str:
    return f"{base.rstrip('/')}/Metadata/{FOLDER[entity]}"


def landing_path(entity: str, day: Column, key: Column, ordinal: Column) -> Column:
    """FN-6: ``Metadata/<E>/<day>/<day>_metadata_<E>_<key>_<n>.json``."""
    folder = FOLDER[entity]
    return F.concat(
        F.lit(f"Metadata/{folder}/"), day, F.lit("/"), day,
        F.lit(f"_metadata_{folder}_"), key, F.lit("_"), ordinal.cast("string"), F.lit(".json"),
    )


def with_day(df: DataFrame, day=None, ts_col: str | None = None) -> DataFrame:
    """Adds the unpadded day partition column from a fixed day or a timestamp column."""
    if ts_col is not None:
        return df.withColumn(DAY_COL, dash_date(ts_col))
    if day is None:
        return df.withColumn(DAY_COL, dash_date(F.current_date()))
    return df.withColumn(DAY_COL, F.lit(day_text(day)))


def day_folder(entity: str, day: str) -> str:
    """A day's folder of an entity, below the landing base."""
    return f"Metadata/{FOLDER[entity]}/{DAY_COL}={day_text(day)}"


def _merge_day(df: DataFrame, base: str, entity: str, day: str) -> tuple[DataFrame, DataFrame | None]:
    """What to append to the day, and the names of the files (``file_name``) that it replaces.

    A file is replaced if it holds a record that is landed again; its other records are
    appended with the new rows. Files without such a record stay as they are, and so does a file with
    a line that the strict load would refuse: it keeps every line and stays refused.
    """
    from ..sources.landed import read_lines
    from .warehouse import line_checks   # these modules read this one's layout

    spark = df.sparkSession
    if not path_exists(spark, f"{base.rstrip('/')}/{day_folder(entity, day)}"):
        return df, None
    wire = T.StructType([f for f in df.schema.fields if f.name != RECORD])
    lines = read_lines(spark, entity_dir(base, entity), day).drop("file_path")
    checked = line_checks(lines, wire).select("value", "file_name", "is_bad", F.try_variant_get("v", f"$.{RECORD}", "string").alias(RECORD))
    again = df.select(RECORD).distinct().withColumn("again", F.lit(True))
    marked = checked.join(again, RECORD, "left")
    # Checked and joined once: the lines that may be kept, and a mark for each other line.
    path = work_dir(spark, "landing-marked")
    marked.select("file_name", "is_bad", "again", F.when(F.col("again").isNull(), F.col("value")).alias("value")).write.parquet(path)
    marked = spark.read.schema("file_name string, is_bad boolean, again boolean, value string").parquet(path)
    files = marked.groupBy("file_name").agg(F.bool_or("is_bad").alias("bad"), F.count("again").alias("hits")).where("NOT bad AND hits > 0")
    # Decided once, before anything is written.
    path = work_dir(spark, "landing-replaced")
    files.select("file_name").write.parquet(path)
    files = spark.read.schema("file_name string").parquet(path)
    kept = (marked.where("again IS NULL").join(files, "file_name", "left_semi")
            .select(F.from_json("value", df.schema).alias("r")).select("r.*"))
    return df.unionByName(kept), files


def land(df: DataFrame, base: str, entity: str, day=None, ts_col: str | None = None,
         files_per_day: int | None = None, spread_col: str | None = None, merge: bool = False,
         change: manifest.Change | None = None) -> str:
    """SNK-1: write one entity's rows as JSON, one directory per day.

    ``files_per_day`` bounds the number of files per day directory: rows of a
    day are hash-spread (on ``spread_col``, default the first column, e.g. the
    record id) over that many buckets, so a day is never forced into one task
    and never scattered into one file per task.

    Without it, rows landed by their own days (``ts_col``) are gathered by day to
    files of about the advisory partition size; Spark splits a large day and
    joins small ones, so tasks times days is not the number of files.

    ``merge=True`` (rows carrying ``_record``, one fixed ``day``) reproduces
    per-record files: a re-run of the same day replaces the records it lands
    again and keeps the day's other records. Without it the day is replaced.
    A merge is one change of the manifest under ``base``: readers of ``sources.landed`` see the day before it or after it, also if
    the run is lost in between; what it left is not read and goes with the next merge of the day. A given ``change`` (of
    the day's folder and perhaps others) is not committed here, so that several entities can become visible at once.
    """
    target, spark = entity_dir(base, entity), df.sparkSession
    own = None
    if merge:
        if ts_col is not None or day is None or RECORD not in df.columns:
            raise ValueError("merge needs a fixed day and a _record column")
        folder = day_folder(entity, day)
        own = change or manifest.Change(spark, base, [folder])
        df, replaced = _merge_day(df, base, entity, day)
        if replaced is not None:
            own.drop(folder, replaced)
    out = with_day(df, day, ts_col)
    if files_per_day:
        key = F.col(spread_col or df.columns[0])
        bucket = F.pmod(F.xxhash64(key), F.lit(files_per_day))
        out = out.repartition(F.col(DAY_COL), bucket)
    elif ts_col is not None:
        out = out.hint("rebalance", F.col(DAY_COL))
    (out.write.mode("append" if merge else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**JSON_WRITE_OPTIONS)
        .partitionBy(DAY_COL)
        .json(target))
    if not merge:
        manifest.refresh(spark, base, f"Metadata/{FOLDER[entity]}/")
    elif change is None:
        own.commit()
        manifest.vacuum(spark, base, [folder])
    return target


def land_legacy(df: DataFrame, base: str, entity: str) -> str:
    """SNK-9: older layout ``<Entity>/``, no day, no Timestamp, overwritten each run."""
    out = df.drop("Timestamp")
    if entity == "caption" and "Contents_caption_id" in out.columns:
        out = out.withColumnRenamed("Contents_caption_id", "Caption_id")
    target = f"{base.rstrip('/')}/{FOLDER[entity]}"
    out.write.mode("overwrite").options(**JSON_WRITE_OPTIONS).json(target)
    return target
