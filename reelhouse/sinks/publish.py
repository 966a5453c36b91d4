"""J11: publish requests (SNK-11) from a queue table.

Each queued video becomes one nested JSON request: snippet (title,
description, categoryId, tags), status (privacy, publish time ten days
ahead in ISO form with milliseconds and ``Z``, made-for-kids flag) and the
notify flag. Sending the request is outside Spark and not built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import iso_in_days, to_json_keep_nulls

PUBLISH_DELAY_DAYS = 10


def request_struct(now: Column, privacy: str = "private", made_for_kids: bool = False,
                   notify: bool = False) -> Column:
    return F.struct(
        F.struct(
            F.col("title"), F.col("description"), F.col("categoryId"), F.col("tags"),
        ).alias("snippet"),
        F.struct(
            F.lit(privacy).alias("privacyStatus"),
            iso_in_days(now, PUBLISH_DELAY_DAYS).alias("publishedAt"),
            F.lit(made_for_kids).alias("selfDeclaredMadeForKids"),
        ).alias("status"),
        F.lit(notify).alias("notifySubscribers"),
    )


def publish_requests(queue: DataFrame, now: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Queue rows -> ``request`` JSON text (nulls kept), plus any ``keep`` columns."""
    ts = now if now is not None else F.current_timestamp()
    return queue.select(*(keep or []), to_json_keep_nulls(request_struct(ts)).alias("request"))
