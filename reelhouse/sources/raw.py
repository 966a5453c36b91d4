"""Raw documents (SRC-1, SRC-2) and the fatal missing-id rule (FLT-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.lookups import SEARCH_TERM


def read_raw_videos(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON video documents with the declared schema (no inference pass)."""
    return spark.read.schema(schemas.RAW_VIDEO).json(path)


def read_raw_channels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_CHANNEL).json(path)


def parse_videos(df: DataFrame, text_col: str = "value") -> DataFrame:
    """JSON text column -> raw video columns (one ``from_json`` per row)."""
    return df.select(F.from_json(F.col(text_col), schemas.RAW_VIDEO).alias("d")).select("d.*")


def parse_channels(df: DataFrame, text_col: str = "value") -> DataFrame:
    return df.select(F.from_json(F.col(text_col), schemas.RAW_CHANNEL).alias("d")).select("d.*")


def first_page(feed: DataFrame, term: str = SEARCH_TERM) -> DataFrame:
    """SRC-1 / LIM-3: only the first results page of the fixed search term."""
    return feed.where((F.col("search_term") == F.lit(term)) & (F.col("page") == F.lit(1)))


def strict_video_id(id_col: Column) -> Column:
    """FLT-6: a search result without a video id fails the whole job."""
    return F.when(id_col.isNull(), F.raise_error(F.lit("search result without videoId"))).otherwise(id_col)


def with_video_id(feed: DataFrame) -> DataFrame:
    """Adds ``video_id`` (strict) from ``vid_info.videoDetails.videoId``."""
    return feed.withColumn("video_id", strict_video_id(F.col("vid_info.videoDetails.videoId")))
