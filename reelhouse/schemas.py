"""Schemas: raw documents in, the four warehouse tables out.

Every warehouse column is nullable, as declared by the loaders being
rebuilt. Integers are BIGINT, floats DOUBLE. The channel column
``Subcribed`` keeps its original spelling: it is part of the table contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I, B = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw video document (one row per video) --------------------------------
IMAGE = _struct(("url", S), ("width", L), ("height", L))
IMAGES = _struct(("thumbnails", T.ArrayType(IMAGE)))
STREAM = _struct(("itag", I), ("progressive", B), ("file_extension", S))
CAPTION_TRACK = _struct(("name", S), ("code", S))
CAPTION_CONTENT = _struct(("code", S), ("json_captions", S))

RAW_VIDEO = _struct(
    ("search_term", S),
    ("page", I),
    ("vid_info", _struct(("videoDetails", _struct(("videoId", S), ("thumbnail", IMAGES))))),
    ("channel_id", S),
    ("channel_url", S),
    ("length", L),
    ("publish_date", T.TimestampNTZType()),
    ("title", S),
    ("views", L),
    ("age_restricted", B),
    ("streams", T.ArrayType(STREAM)),
    ("caption_tracks", T.ArrayType(CAPTION_TRACK)),
    ("captions", T.ArrayType(CAPTION_CONTENT)),
)

# --- raw channel document (one row per channel url) ------------------------
GRID_ITEM = _struct(
    (
        "richItemRenderer",
        _struct(
            (
                "content",
                _struct(
                    (
                        "videoRenderer",
                        _struct(
                            ("videoId", S),
                            ("descriptionSnippet", _struct(("runs", T.ArrayType(_struct(("text", S)))))),
                        ),
                    )
                ),
            )
        ),
    )
)
TAB = _struct(
    (
        "tabRenderer",
        _struct(("content", _struct(("richGridRenderer", _struct(("contents", T.ArrayType(GRID_ITEM))))))),
    )
)
# Artwork types, in the order their ordinals continue (fixed values).
ARTWORK_TYPES = ("avatar", "banner", "mobileBanner")

RAW_CHANNEL = _struct(
    ("channel_url", S),
    ("channel_id", S),
    ("channel_name", S),
    (
        "initial_data",
        _struct(
            (
                "metadata",
                _struct(("channelMetadataRenderer", _struct(("description", S), ("keywords", S)))),
            ),
            (
                "header",
                _struct(
                    (
                        "c4TabbedHeaderRenderer",
                        _struct(
                            ("subscriberCountText", _struct(("simpleText", S))),
                            *[(t, IMAGES) for t in ARTWORK_TYPES],
                        ),
                    )
                ),
            ),
            (
                "contents",
                _struct(("twoColumnBrowseResultsRenderer", _struct(("tabs", T.ArrayType(TAB))))),
            ),
        ),
    ),
)

# --- warehouse tables -------------------------------------------------------
VIDEO = _struct(
    ("VideoID", S), ("ChannelID", S), ("Length", L), ("Publish_date", S),
    ("Title", S), ("Views", L), ("Description", S), ("Timestamp", D),
)
CHANNEL = _struct(
    ("ChannelID", S), ("URL", S), ("Name", S), ("Description", S),
    ("Subcribed", S), ("Keywords", S), ("Timestamp", D),
)
# Contents is semi-structured: VARIANT in the table, JSON text on the wire.
CAPTION = _struct(
    ("Contents_caption_id", S), ("VideoID", S), ("Language", S),
    ("Contents", T.VariantType()), ("Timestamp", D),
)
CAPTION_WIRE = _struct(
    ("Contents_caption_id", S), ("VideoID", S), ("Language", S), ("Contents", S), ("Timestamp", D),
)
THUMBNAIL = _struct(
    ("ThumbnailID", S), ("VideoID", S), ("URL", S), ("Width", L), ("Height", L), ("Timestamp", D),
)
ARTWORK = _struct(
    ("VideoID", S), ("ChannelID", S), ("Type", S), ("URL", S), ("Width", L), ("Height", L),
)
CATEGORY = _struct(("id", S), ("title", S))
CATEGORY_RESPONSE = _struct(("items", T.ArrayType(_struct(("id", S), ("snippet", _struct(("title", S)))))))

TABLES: dict[str, T.StructType] = {
    "video": VIDEO,
    "channel": CHANNEL,
    "caption": CAPTION,
    "thumbnail": THUMBNAIL,
}


def legacy(entity: str) -> T.StructType:
    """Older layout: no Timestamp; the caption key is called Caption_id."""
    fields = [f for f in TABLES[entity].fields if f.name != "Timestamp"]
    if entity == "caption":
        fields = [T.StructField("Caption_id", S, True) if f.name == "Contents_caption_id" else f for f in fields]
    return T.StructType(fields)


LOAD_REPORT = _struct(("file_path", S), ("file_name", S), ("n_rows", L), ("n_bad", L), ("status", S))
MEDIA_MANIFEST = _struct(("src_path", S), ("dest_path", S), ("content_type", S), ("length", L))
PUBLISH_QUEUE = _struct(("title", S), ("description", S), ("categoryId", I), ("tags", T.ArrayType(S)))
