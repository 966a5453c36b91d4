"""Hot-key splitting for many-to-one joins (a key may hold a third of all rows).

``hot_keys`` finds the keys above a share of the rows with one aggregate
(combined map-side, so even the hottest key is a handful of partial counts)
and returns at most ``1 / min_share`` keys: a proven bound, safe to
broadcast. ``salted_join`` then spreads each hot key of the large side over
``buckets`` tasks with a deterministic salt (a hash of the row, so a
recomputed task salts exactly as before) and replicates only the hot keys'
rows of the one-row-per-key side. Cold keys join unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def hot_keys(df: DataFrame, key: str, min_share: float = 0.05) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows (at most 1/min_share keys)."""
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be in (0, 1]")
    total = df.agg(F.count(F.lit(1))).scalar()   # scalar subquery, evaluated once
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") >= total * F.lit(min_share)).select(key)


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: DataFrame, buckets: int = 16,
                how: str = "inner", salt_cols: list[str] | None = None) -> DataFrame:
    """``big JOIN small USING (key)`` with hot keys split over ``buckets`` salts.

    ``small`` must hold at most one row per key (a lookup side); ``hot`` is a
    bounded key list (e.g. from :func:`hot_keys`). ``salt_cols`` pick the
    columns hashed for the salt (default: all columns of ``big``).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    flag = hot.select(key).distinct().withColumn("_hot", F.lit(True))
    # Broadcast: hot_keys() bounds the list by 1 / min_share.
    cols = [F.col(c) for c in (salt_cols or big.columns)]
    b = (big.join(F.broadcast(flag), key, "left")
         .withColumn(SALT, F.when(F.col("_hot"), F.pmod(F.xxhash64(*cols), F.lit(buckets).cast("bigint")))
                     .otherwise(F.lit(0).cast("bigint")))
         .drop("_hot"))
    s = (small.join(F.broadcast(flag), key, "left")
         .withColumn(SALT, F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint")))
                                     .otherwise(F.array(F.lit(0).cast("bigint")))))
         .drop("_hot"))
    return b.join(s, [key, SALT], how).drop(SALT)
