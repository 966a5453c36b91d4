"""J5 / J6: media eligibility and the "not yet stored" anti join.

A video is taken only if none of three conditions holds (FLT-1): it is
age-restricted (FLT-2), it is already stored (FLT-3, a substring test
against every object name), or it has no progressive mp4 stream with itag
22 (FLT-4; a missing stream list counts as "no stream").

The substring test (JOIN-2) never compares every candidate with every name.
Names are probed in place with a Bloom filter of the candidate keys
(``operators/bloom.py``), and only the pieces that pass are shuffled and
matched by *equality*, which is the exact test. ``method="grams"`` is the
same test without Python: each name is exploded into its substrings of the
key lengths that occur, and these are matched. Key lengths (bounded by the
longest key) and the filter (bounded in bits) are all that comes to the driver.

Substring false positives (an id inside a longer id or a metadata file
name) are kept: that is the rule being rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom


def no_itag_22(streams: Column | str) -> Column:
    """FLT-4: true when no progressive mp4 stream has itag 22 (null list -> true)."""
    s = F.col(streams) if isinstance(streams, str) else streams
    mp4 = F.filter(s, lambda x: x["progressive"] & (x["file_extension"] == "mp4"))
    return ~F.coalesce(F.exists(mp4, lambda x: x["itag"] == 22), F.lit(False))


def _key_lengths(candidates: DataFrame, key: str) -> list[int]:
    """Distinct key lengths: at most as many values as the longest key has characters."""
    rows = candidates.select(F.length(key).alias("n")).where("n IS NOT NULL").distinct().collect()
    return sorted(int(r.n) for r in rows)


def name_substrings(names: DataFrame, name_col: str, lengths: list[int]) -> DataFrame:
    """Substrings of the given lengths of all names (column ``gram``), each name's own ones once."""
    n = F.length(F.col(name_col))
    none = F.array().cast("array<string>")

    def windows(L: int):
        # One-argument lambda: transform() treats a second parameter as the index.
        starts = F.sequence(F.lit(1), n - F.lit(L) + 1)
        return F.when(n >= F.lit(L), F.transform(starts, lambda i: F.substring(F.col(name_col), i, L))).otherwise(none)

    per_len = [windows(L) if L > 0 else F.array(F.lit("")) for L in lengths]
    grams = F.flatten(F.array(*per_len)) if per_len else F.array().cast("array<string>")
    return (
        names.where(F.col(name_col).isNotNull())
        .select(F.explode(F.array_distinct(grams)).alias("gram"))
    )


def stored_keys(candidates: DataFrame, names: DataFrame, key: str = "video_id",
                name_col: str = "path", method: str = "bloom") -> DataFrame:
    """Distinct candidate keys found as a substring of some name (column ``key``)."""
    keys = candidates.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    if method == "bloom":
        grams = bloom.windows(names.select(name_col), keys)
    elif method == "grams":
        grams = name_substrings(names, name_col, _key_lengths(candidates, key))
    else:
        raise ValueError(f"unknown method {method!r}")
    return keys.join(grams, keys[key] == grams["gram"], "left_semi")


def not_stored(candidates: DataFrame, names: DataFrame, key: str = "video_id", name_col: str = "path", method: str = "bloom") -> DataFrame:
    """JOIN-2 / FLT-3: candidates whose key is a substring of no name."""
    # Match distinct keys first (a key repeated by a third of all candidates is
    # one row here), then drop the hits from the candidates.
    hits = stored_keys(candidates, names, key, name_col, method)
    return candidates.join(hits, key, "left_anti")


def in_scope(listing: DataFrame, name_col: str = "path", scope: str | None = None) -> DataFrame:
    """H4: every object, or those with the prefix ``scope``."""
    if scope is None:
        return listing
    return listing.where(F.col(name_col).startswith(scope))


def with_stored_flag(candidates: DataFrame, names: DataFrame, key: str = "video_id",
                     name_col: str = "path") -> DataFrame:
    hits = stored_keys(candidates, names, key, name_col).withColumn("_hit", F.lit(True))
    return (candidates.join(hits, key, "left")
            .withColumn("is_stored", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def classify(candidates: DataFrame, names: DataFrame, key: str = "video_id", name_col: str = "path",
             restricted: str = "age_restricted", streams: str = "streams") -> DataFrame:
    """FLT-1 with every condition evaluated: adds flags and ``reject_reason``.

    ``eligible`` is true when all three conditions are false (AGG-2).
    """
    flagged = with_stored_flag(candidates, names, key, name_col)
    is_restricted = F.coalesce(F.col(restricted), F.lit(False))
    lacks_stream = no_itag_22(streams)
    reason = F.concat_ws(
        ",",
        F.when(is_restricted, F.lit("age_restricted")),
        F.when(F.col("is_stored"), F.lit("already_stored")),
        F.when(lacks_stream, F.lit("no_itag_22")),
    )
    return (flagged.withColumn("is_restricted", is_restricted)
            .withColumn("no_itag_22", lacks_stream)
            .withColumn("eligible", ~(F.col("is_restricted") | F.col("is_stored") | F.col("no_itag_22")))
            .withColumn("reject_reason", F.when(reason == "", None).otherwise(reason)))


def eligible(candidates: DataFrame, names: DataFrame, key: str = "video_id", name_col: str = "path",
             restricted: str = "age_restricted", streams: str = "streams") -> DataFrame:
    """Accepted candidates only; the cheap row-local filters run before the anti join."""
    pre = candidates.where(~F.coalesce(F.col(restricted), F.lit(False)) & ~no_itag_22(streams))
    return not_stored(pre, names, key, name_col)


def any_all_flags(df: DataFrame, group: str, any_cond: Column, all_cond: Column) -> DataFrame:
    """AGG-1 / AGG-2 across rows: ``bool_or`` and ``bool_and`` per group."""
    return df.groupBy(group).agg(F.bool_or(any_cond).alias("any_flag"), F.bool_and(all_cond).alias("all_flag"))
