"""Constant lookups (content type by extension, folder by entity).

They are small literal maps, so they are applied as ``create_map`` literals
inside the projection: no join and no broadcast is planned for them.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the rebuilt system's configuration.
CONTENT_TYPE = {"json": "application/json", "mp4": "video/mp4"}
FOLDER = {"video": "Video", "caption": "Caption", "thumbnail": "Thumbnail", "channel": "Channel"}
SEARCH_TERM = "meme"
WATCH_URL_PREFIX = "https://www.youtube.com/watch?v="
DEFAULT_CONTENT_TYPE = "application/octet-stream"


def map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def lookup(d: dict[str, str], key: Column, default: str | None = None) -> Column:
    """``d[key]`` as a column; ``default`` when the key is absent."""
    value = F.try_element_at(map_literal(d), key)
    return value if default is None else F.coalesce(value, F.lit(default))
