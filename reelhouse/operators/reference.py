"""J10 category table (PRJ-5, SET-2, UDF-4) and J12 channel artwork (PRJ-6, WIN-2).

Both flatten arrays that live inside one document row, so they are
generator + projection plans with no shuffle: the artwork ordinal that
continues across image types is the position in the concatenation of the
per-type arrays (types in their fixed order), not a window over a channel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ARTWORK_TYPES

_HEADER = "initial_data.header.c4TabbedHeaderRenderer"


def categories(responses: DataFrame, items_col: str = "items") -> DataFrame:
    """Category response(s) -> (id, title): explode items, expand the snippet."""
    return responses.select(F.explode(items_col).alias("it")).select(
        F.col("it.id").alias("id"), F.col("it.snippet.title").alias("title"))


def channel_artwork(channels: DataFrame, types: tuple[str, ...] = ARTWORK_TYPES,
                    start: int = 0) -> DataFrame:
    """Rows per image of every artwork type, ordinal continuing across types.

    Output: ChannelID, VideoID (always null), Type, URL, Width, Height, ordinal.
    A missing type contributes no rows.
    """

    def tag(t: str):
        # One-argument lambda: transform() treats a second parameter as the index.
        return F.transform(F.coalesce(F.col(f"{_HEADER}.{t}.thumbnails"), F.array()),
                           lambda x: F.struct(F.lit(t).alias("type"), x.alias("img")))

    tagged = [tag(t) for t in types]
    return channels.select("channel_id", F.posexplode(F.flatten(F.array(*tagged))).alias("pos", "a")).select(
        F.lit(None).cast("string").alias("VideoID"),
        F.col("channel_id").alias("ChannelID"),
        F.col("a.type").alias("Type"),
        F.col("a.img.url").alias("URL"),
        F.col("a.img.width").alias("Width"),
        F.col("a.img.height").alias("Height"),
        (F.col("pos") + F.lit(start + 1)).cast("bigint").alias("ordinal"),
    )
