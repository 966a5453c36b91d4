"""Packing into length buckets that waste the least padding.

Texts longer than `window` tokens are cut into pieces of `window` tokens and a rest, so nothing
is dropped. The global histogram of piece lengths (at most `window` + 1 rows) goes to the
driver, where dynamic programming finds the bucket boundaries with the least total
padding: the best cost of the first j lengths in k buckets is the minimum, over i, of the best
cost of i lengths in k - 1 buckets plus padding lengths i+1..j to length j. That is a
minimum over lines in the length, taken with a convex hull, so a layer costs linear time.

Inside each bucket, sequences form batches of at most `budget` padded tokens. A sequence's rank
in its bucket is its rank in a segment of about `SEGMENT` sequences plus the sizes of the
segments before; no bucket, however full, meets in one task.

Null lengths count as 0; a piece of 0 tokens still takes a place in the first bucket. Repeated rows are sequences of their
own. An empty table gives an empty result. Only the id and the length are read, so extra
columns cannot clash.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import stage

WINDOW, BUCKETS, BUDGET, SEGMENT = 8_192, 16, 65_536, 50_000


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The at most ``buckets`` boundaries (ascending; the last is the longest length) of least padding."""
    lengths = sorted(histogram)
    n = len(lengths)
    if not n:
        return []
    rows, tokens = [0], [0]
    for x in lengths:
        rows.append(rows[-1] + histogram[x])
        tokens.append(tokens[-1] + x * histogram[x])
    # One bucket: everything up to length j is padded to it.
    cost = [0, *(lengths[j - 1] * rows[j] - tokens[j] for j in range(1, n + 1))]
    came: list[list[int]] = [[0] * (n + 1)]
    for _ in range(1, min(buckets, n)):
        hull: deque[tuple[int, int, int]] = deque()      # lines (slope, intercept, i): cost[i] + tokens[i] - rows[i] * length
        now, source = cost[:], [0] * (n + 1)
        for j in range(1, n + 1):
            line = (-rows[j - 1], cost[j - 1] + tokens[j - 1], j - 1)
            while len(hull) > 1 and _useless(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            x = lengths[j - 1]
            while len(hull) > 1 and hull[1][0] * x + hull[1][1] <= hull[0][0] * x + hull[0][1]:
                hull.popleft()
            slope, intercept, i = hull[0]
            now[j], source[j] = x * rows[j] - tokens[j] + slope * x + intercept, i
        cost, came = now, [*came, source]
    out, j = [], n
    for source in reversed(came):
        if not j:
            break
        out.append(lengths[j - 1])
        j = source[j]
    return out[::-1]


def _useless(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether line b is nowhere below both a and c (slopes fall from a to c)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pieces(docs: DataFrame, length: Column, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """(row, doc_id, piece, n_tokens): each text in pieces of at most ``window`` tokens; written once."""
    n = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), n.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / window).cast("long") - 1, F.lit(0).cast("long"))
    cut = rows.select("row", "doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    return stage(cut.select("row", "doc_id", "piece", F.least(F.col("n") - F.col("piece") * window, F.lit(window)).alias("n_tokens")), "packing-pieces")


def pack(docs: DataFrame, length: Column, id_col: str = "doc_id", window: int = WINDOW, buckets: int = BUCKETS,
         budget: int = BUDGET, segment: int = SEGMENT) -> DataFrame:
    """One row for each piece: (doc_id, piece, n_tokens, bucket, bucket_len, batch, slot, padding).

    ``batch`` counts from 0 in each bucket; a batch holds max(1, ``budget`` // ``bucket_len``) sequences.
    """
    cut = pieces(docs, length, id_col, window)
    histogram = {r["n_tokens"]: r["count"] for r in cut.groupBy("n_tokens").count().collect()}     # at most window + 1 rows
    ends = boundaries(histogram, buckets)
    if not ends:
        ends, filled = [window], [0]
    else:
        starts = [-1, *ends[:-1]]
        filled = [sum(c for x, c in histogram.items() if a < x <= b) for a, b in zip(starts, ends, strict=True)]

    def of_bucket(numbers: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast("long") for x in numbers]), F.col("bucket") + 1)

    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in ends[:-1]), F.lit(0))
    placed = cut.withColumn("bucket", bucket).withColumn("bucket_len", of_bucket(ends))
    place = F.xxhash64("row", "piece")
    placed = placed.withColumn("seg", F.pmod(place, of_bucket([max(1, -(-x // segment)) for x in filled])))
    sizes = placed.groupBy("bucket", "seg").agg(F.count("*").alias("k"))
    before = W.partitionBy("bucket").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)     # one row for each segment
    offsets = sizes.select("bucket", "seg", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    ranked = placed.withColumn("rn", F.row_number().over(W.partitionBy("bucket", "seg").orderBy(place, "row", "piece")))
    rank = F.col("offset") + F.col("rn") - 1
    room = of_bucket([max(1, budget // max(1, x)) for x in ends])
    return ranked.join(offsets, ["bucket", "seg"]).select(
        "doc_id", "piece", "n_tokens", "bucket", "bucket_len", F.floor(rank / room).alias("batch"), F.pmod(rank, room).alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
