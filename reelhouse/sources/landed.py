"""SRC-4 / SRC-5: read one day of a landing folder, ``.json`` files only.

The day is a string partition value compared exactly (``2024-1-1`` is not
``2024-1-10``), so the filter becomes a partition filter and only that
day's directory is listed and read. Of a day that was merged, the files
that its manifest counts are read, so a merge is seen as a whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from ..sinks import manifest
from ..sinks.landing import DAY_COL, day_text


def _below_root(entity_path: str) -> tuple[str, str] | None:
    """(landing base, folder below it) of an entity's folder in the landing layout."""
    base, found, folder = entity_path.rstrip("/").rpartition("/Metadata/")
    return (base, f"Metadata/{folder}") if found else None


def counted_files(spark: SparkSession, entity_path: str, day: str) -> list[str] | None:
    """The ``.json`` files of a day that its manifest counts; None if no manifest names the day (all that lie there count)."""
    at, folder = _below_root(entity_path), f"{DAY_COL}={day_text(day)}"
    if at is None or not manifest.managed(spark, at[0], f"{at[1]}/{folder}"):
        return None
    names = manifest.current(spark, at[0], f"{at[1]}/{folder}").where("file LIKE '%.json'").collect()     # Spark's own file index holds as many
    return [f"{entity_path.rstrip('/')}/{folder}/{r.file}" for r in names]


def _counted(df: DataFrame, entity_path: str, day: Column) -> DataFrame:
    """``df`` of all days (with a ``file_name``) without the lines of files that the landing's manifest does not count."""
    at = _below_root(entity_path)
    if at is None or not manifest.version(df.sparkSession, at[0]):
        return df
    gone = manifest.stray(df.sparkSession, at[0], at[1] + "/").select(F.substring_index("folder", "=", -1).alias("_day"), F.col("file").alias("_file"))
    return df.join(gone, (day == F.col("_day")) & (F.col("file_name") == F.col("_file")), "left_anti")


def read_day(spark: SparkSession, entity_path: str, schema: T.StructType, day: str | None = None) -> DataFrame:
    """Typed rows of the landed JSON (plus ``ingest_date``), pruned to ``day``."""
    full = T.StructType(list(schema.fields) + [T.StructField(DAY_COL, T.StringType(), True)])
    reader = spark.read.schema(full).option("pathGlobFilter", "*.json")
    if day is None:
        df = reader.json(entity_path)
        named = df.select("*", F.col("_metadata.file_name").alias("file_name"))
        counted = _counted(named, entity_path, F.col(DAY_COL))
        return df if counted is named else counted.drop("file_name")
    files = counted_files(spark, entity_path, day)
    if files is None:
        return reader.json(entity_path).where(F.col(DAY_COL) == F.lit(day_text(day)))
    return reader.option("basePath", entity_path).json(files) if files else spark.createDataFrame([], full)


def read_lines(spark: SparkSession, entity_path: str, day: str | None = None) -> DataFrame:
    """Raw lines with their file (``value, file_path, file_name``)."""
    src = entity_path if day is None else f"{entity_path.rstrip('/')}/{DAY_COL}={day_text(day)}"
    files = None if day is None else counted_files(spark, entity_path, day)
    if files == [] or not path_exists(spark, src):   # nothing landed for that day: nothing to load
        return spark.createDataFrame([], "value string, file_path string, file_name string")
    df = (spark.read.option("pathGlobFilter", "*.json").text(files or src)
          .select("value", F.col("_metadata.file_path").alias("file_path"),
                  F.col("_metadata.file_name").alias("file_name")))
    if day is None:
        df = _counted(df, entity_path, F.regexp_extract("file_path", f"{DAY_COL}=([^/]*)/", 1))
    return df.where(F.trim("value") != "")
