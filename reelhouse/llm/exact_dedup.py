"""Exact dedup against a persistent digest index.

The index is a Parquet table, bucketed and sorted by the digest of the normalised text, with
one row for each text ever seen: (digest, keep_id, batch). A new batch is reduced to its digests
with map-side combining, the digests that the index has are removed by a sort-merge
anti-join in which the index is read by bucket and never shuffled, and the rest is appended.
Every row of the batch then looks up which row stays.

Only digests and ids are shuffled, never texts. A text that holds a large share of the rows
is combined before the shuffle; its rows are answered from a broadcast list of at most
`HOT_SHARE` texts instead of meeting in one task of the final join.

Recovery: the batch's ids and digests are written once under the checkpoint folder, so that a
lost executor costs a re-read; an append is one commit, and a batch that is ingested again
adds nothing.

Null texts count as empty. Of equal texts the smallest id stays (null ids come last), and of
repeated rows with that id exactly one. Empty tables give empty results and append nothing.
`deduplicate` packs each row into one struct, so no name of an extra column can clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import stage, utf8
from reelhouse.session import path_exists, work_dir

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: Texts with at least 1 / HOT_SHARE of a batch's rows are hot: there are HOT_SHARE of them at most.
HOT_SHARE = 200
#: A new index gets a bucket for each so many expected digests (about 200 MB of them), between two bounds;
#: the upper one is Spark's own largest number of buckets.
DIGESTS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 64, 100_000


def text_digest(text: Column | str) -> Column:
    """SHA-256 (32 bytes) of the text with runs of ASCII white space replaced by one space."""
    return F.unhex(F.sha2(F.regexp_replace(utf8(text), WHITE_SPACE, " ").cast("binary"), 256))


def _made_with(spark: SparkSession, path: str) -> list[int]:
    """The numbers of buckets of the indexes at ``path``, from their folders' names."""
    if not path_exists(spark, path):
        return []
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [f.getPath().getName() for f in found]
    return sorted(int(x.partition("=")[2]) for x in names if x.startswith("digest_buckets="))


class DigestIndex:
    """The persistent index at ``path``; reopened by path, with the buckets it was made with (``buckets`` is for a new one)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        made = _made_with(spark, path)
        if len(made) > 1:
            raise ValueError(f"{path} holds several indexes, with {made} buckets; merge them first")
        buckets = made[0] if made else buckets
        self.spark, self.buckets = spark, buckets
        self.path = f"{path.rstrip('/')}/digest_buckets={buckets}"
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        known = path_exists(spark, self.path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")
        if known:
            spark.catalog.refreshTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def ingest(self, rows: DataFrame) -> DataFrame:
        """Add a batch of (row, id, digest); its decisions: (row, id, digest, keep_id, group_size, kept).

        ``rows`` is a written table with a unique ``row`` for each row. ``group_size`` counts the
        batch's rows of equal text; ``kept`` marks the row that stays, none if an earlier
        batch had the text.
        """
        batch = uuid.uuid4().hex
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first")
        groups = stage(rows.groupBy("digest").agg(first, F.count("*").alias("n")).repartition(self.buckets, "digest"), "digest-groups")
        by_bucket = groups.repartition(self.buckets, "digest")
        fresh = by_bucket.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        fresh = fresh.select("digest", F.col("first.id").alias("keep_id"), F.lit(batch).alias("batch"))
        fresh.repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

        answers = stage(by_bucket.join(self.read().hint("merge"), "digest").select(
            "digest", F.col("keep_id"), F.col("n").alias("group_size"),
            F.when(F.col("batch") == batch, F.col("first.row")).alias("keep_row")), "digest-answers")
        total = answers.agg(F.sum("group_size")).first()[0] or 0
        is_hot = F.col("group_size") >= max(2, -(-total // HOT_SHARE))
        hot = answers.filter(is_hot).select("digest", F.struct("keep_id", "group_size", "keep_row").alias("hot"))
        marked = rows.join(F.broadcast(hot), "digest", "left")            # at most HOT_SHARE rows
        answered = marked.filter("hot IS NOT NULL").select("row", "id", "digest", "hot.*")
        others = marked.filter("hot IS NULL").drop("hot").join(answers.filter(~is_hot), "digest")
        both = others.select("row", "id", "digest", "keep_id", "group_size", "keep_row").unionByName(answered)
        return both.withColumn("kept", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))).drop("keep_row")


def buckets_for(rows: int) -> int:
    """Buckets of an index that is to hold the digests of ``rows`` texts; a bucket is one task's share."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows // DIGESTS_PER_BUCKET)))


def new_index(spark: SparkSession, buckets: int = LEAST_BUCKETS) -> DigestIndex:
    """An empty index of this run under the shared checkpoint folder; see `buckets_for`."""
    return DigestIndex(spark, work_dir(spark, "digest-index"), buckets)


def numbered(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, digest) of each row of ``docs``, written once so that the row numbers hold."""
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                             text_digest(text).alias("digest")), "digest-rows")


def decisions(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Ingest ``docs``; one row for each of its rows: (doc_id, keep_id, group_size, kept, text_sha256)."""
    got = index.ingest(numbered(docs, id_col, text))
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the same columns.

    Rows are written once with their numbers; the kept rows come back by number.
    """
    packed = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"), text_digest(text).alias("digest")), "docs-numbered")
    rows = packed.select("row", F.col("doc").getField(id_col).cast("long").alias("id"), "digest")
    kept = index.ingest(rows).filter("kept").select("row")
    return packed.select("row", "doc").join(kept, "row", "left_semi").select("doc.*")
