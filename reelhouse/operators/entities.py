"""J1: raw video + channel documents -> video, channel, caption, thumbnail rows.

Plan shape (one scan of each input):

* channel documents are projected to one narrow row per ``channel_url``
  (channel fields + "grid path present" flag), and separately their grid
  items are exploded and reduced to one row per ``(channel_url, videoId)``
  with the *last* matching description (``max_by`` on the position) and a
  "matching item without text run" flag; that reduction aggregates
  map-side before its shuffle.
* videos join the narrow channel row on ``channel_url`` (inner: a video
  whose channel page is missing yields no entity at all) and the
  description row on ``(channel_url, video_id)`` (left). The second key is
  composite, so when it shuffles a channel holding a third of all videos
  spreads over many tasks; the first join is left to Spark's size-checked
  broadcast / AQE skew-join split, or salted explicitly (``hot_share``).
* the stage cascade (H1) is four boolean columns computed on the joined
  row, arrays are validated with ``forall`` *before* exploding, and the
  four tables are projections of that one row set. No Python UDF.

Null and missing keys cannot be told apart after struct parsing; a null
value is treated as a missing key (the stricter reading).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import epoch_seconds, json_variant, nth, slash_date
from ..session import checkpoint_root, work_dir
from ..sources.raw import strict_video_id
from .skew import hot_keys, salted_join

_HEADER = "initial_data.header.c4TabbedHeaderRenderer"
_META = "initial_data.metadata.channelMetadataRenderer"
_TABS = "initial_data.contents.twoColumnBrowseResultsRenderer.tabs"
#: Fields of a video document that no entity holds.
_NOT_PROJECTED = ("search_term", "page", "age_restricted", "streams")


def grid_contents(tabs: Column) -> Column:
    """Items of the channel's second tab (null when any level is missing)."""
    return nth(tabs, 1)["tabRenderer"]["content"]["richGridRenderer"]["contents"]


def latest_channels(channels: DataFrame) -> DataFrame:
    """One narrow row per channel url: ``doc`` with the channel's fields and grid items.

    Several documents of one channel are reduced to one before any join, so they
    cannot multiply a video's rows. Documents carry no time; the one with the largest hash
    of these fields is taken, which any attempt of a task decides alike (:func:`one_of_each`).
    """
    grid = grid_contents(F.col(_TABS))

    def narrow(item: Column) -> Column:
        renderer = item["richItemRenderer"]["content"]["videoRenderer"]
        runs = renderer["descriptionSnippet"]["runs"]
        first_run = nth(runs, 0)
        return F.struct(renderer["videoId"].alias("item_video_id"), first_run["text"].alias("run_text"),
                        (runs.isNull() | (F.size(runs) == 0) | first_run.isNull()).alias("run_missing"))

    doc = F.struct(
        F.col("channel_id").alias("ch_id"),
        F.col("channel_name").alias("ch_name"),
        F.col(f"{_META}.description").alias("ch_description"),
        F.col(f"{_META}.keywords").alias("ch_keywords"),
        F.col(f"{_HEADER}.subscriberCountText.simpleText").alias("ch_subscribed"),
        F.transform(grid, narrow).alias("grid"),
    )
    return one_of_each(channels.select("channel_url", doc.alias("doc")), "channel_url")


def one_of_each(docs: DataFrame, key: str, unused: tuple[str, ...] = ()) -> DataFrame:
    """One row for each ``key``: of several, the one with the largest content hash. ``unused`` columns count for that and are then left out.

    The parsed documents are written once as a table, so the raw text is read once however often the result is used. Keys that
    occur more than once are found by narrow (key, hash) rows; they are a table of their own, whose size Spark knows. Without
    any, which is usual, the rows are the table's; else only the documents of these keys are compared.
    """
    spark = docs.sparkSession
    cols = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    path = work_dir(spark, "documents-parsed")
    docs.withColumn("_hash", F.xxhash64(*cols)).drop(*unused).write.parquet(path)
    hashed = spark.read.parquet(path)
    path = work_dir(spark, "documents-twice")
    (hashed.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max("_hash").alias("_hash")).where("_n > 1").select(key, "_hash").write.parquet(path))
    twice = spark.read.parquet(path)
    if twice.isEmpty():
        return hashed.drop("_hash")
    single = hashed.join(twice.select(key), key, "left_anti")
    chosen = hashed.join(twice, [key, "_hash"], "left_semi").dropDuplicates([key])       # equal hash: equal content
    return single.unionByName(chosen.select(*single.columns)).drop("_hash")


def channel_facts(latest: DataFrame) -> DataFrame:
    """The channel fields and stage flags of :func:`latest_channels`."""
    return latest.select(
        "channel_url", *[F.col(f"doc.{c}").alias(c) for c in ("ch_id", "ch_name", "ch_description", "ch_keywords", "ch_subscribed")],
        F.col("doc.grid").isNotNull().alias("grid_ok"),
    ).withColumn(
        "channel_fields_ok",
        F.col("ch_description").isNotNull()
        & F.col("ch_keywords").isNotNull()
        & F.col("ch_subscribed").isNotNull(),
    )


def grid_items(latest: DataFrame) -> DataFrame:
    """Exploded grid items: (channel_url, pos, item_video_id, run_text, run_missing)."""
    return latest.select("channel_url", F.posexplode("doc.grid").alias("pos", "item")).select("channel_url", "pos", "item.*")


def lookup_descriptions(items: DataFrame, channel_key: str = "channel_url",
                        video_key: str = "item_video_id", pos: str = "pos",
                        text: str = "run_text", missing: str | None = "run_missing") -> DataFrame:
    """JOIN-1 / AGG-4: last matching item's text per (channel, video).

    ``max_by`` keeps the text of the highest position, null when that text
    is null, as the overwrite loop does. ``desc_bad`` is true when any
    matching item has no text run (that fails the video stage).
    """
    bad = F.coalesce(F.col(missing), F.lit(False)) if missing else F.lit(False)
    return (
        items.where(F.col(video_key).isNotNull())
        .groupBy(channel_key, video_key)
        .agg(F.max_by(F.col(text), F.col(pos)).alias("description"), F.bool_or(bad).alias("desc_bad"))
    )


def join_documents(videos: DataFrame, channels: DataFrame, hot_share: float | None = None,
                   hot_buckets: int = 16, distinct_videos: bool = False) -> DataFrame:
    """Videos with their channel row, description and the H1 stage flags.

    ``hot_share`` splits channels holding at least that share of all videos
    over ``hot_buckets`` tasks (deterministic salt on the video id); without
    it the join is left to size-checked broadcast / AQE skew handling.
    ``distinct_videos`` keeps one document per video (a video listed twice
    lands once); fields of documents that no entity holds are then left out.
    """
    v = videos.withColumn("video_id", strict_video_id(F.col("vid_info.videoDetails.videoId")))
    if distinct_videos:
        v = one_of_each(v, "video_id", _NOT_PROJECTED)
    latest = latest_channels(channels)
    facts = channel_facts(latest)
    desc = lookup_descriptions(grid_items(latest)).withColumnRenamed("item_video_id", "video_id")
    if hot_share:
        hot = hot_keys(v.select("channel_url"), "channel_url", hot_share)
        j = salted_join(v, facts, "channel_url", hot, hot_buckets, "inner", salt_cols=["video_id"])
    else:
        j = v.join(facts, "channel_url", "inner")
    j = j.join(desc, ["channel_url", "video_id"], "left")

    tracks = F.coalesce(F.col("caption_tracks"), F.array())
    thumbs = F.col("vid_info.videoDetails.thumbnail.thumbnails")
    # The caption of each track's code must be there and be JSON: a malformed one fails the stage.
    captions_ok = F.forall(tracks, lambda t: json_variant(F.try_element_at(
        F.filter(F.col("captions"), lambda c: c["code"] == t["code"]), F.lit(-1))["json_captions"]).isNotNull())
    thumbs_ok = thumbs.isNotNull() & F.forall(
        thumbs, lambda t: t["url"].isNotNull() & t["width"].isNotNull() & t["height"].isNotNull()
    )
    video_ok = F.col("publish_date").isNotNull() & F.col("grid_ok") & ~F.coalesce(F.col("desc_bad"), F.lit(False))
    return (
        j.withColumn("video_ok", video_ok)
        .withColumn("emit_channel", F.col("video_ok") & F.col("channel_fields_ok"))
        .withColumn("emit_caption", F.col("emit_channel") & F.coalesce(captions_ok, F.lit(False)))
        .withColumn("emit_thumbnail", F.col("emit_caption") & F.coalesce(thumbs_ok, F.lit(False)))
    )


# --- the four projections (PRJ-1..4); each also works on its own -------------------
RECORD = "_record"


def _record_of_video() -> list[Column]:
    """Per-record landing key ``<video id>_1`` (one record per video)."""
    return [F.concat(F.col("video_id"), F.lit("_1")).alias(RECORD)]


def video_rows(j: DataFrame, run_ts: float | None = None, record: bool = False) -> DataFrame:
    return j.where("video_ok").select(
        *(_record_of_video() if record else []),
        F.col("video_id").alias("VideoID"),
        F.col("channel_id").alias("ChannelID"),
        F.col("length").alias("Length"),
        slash_date("publish_date").alias("Publish_date"),
        F.col("title").alias("Title"),
        F.col("views").alias("Views"),
        F.col("description").alias("Description"),
        epoch_seconds(run_ts).alias("Timestamp"),
    )


def channel_rows(j: DataFrame, run_ts: float | None = None, record: bool = False) -> DataFrame:
    """One row per video (not per channel), as the observation log keeps it."""
    return j.where("emit_channel").select(
        *(_record_of_video() if record else []),
        F.col("ch_id").alias("ChannelID"),
        F.col("channel_url").alias("URL"),
        F.col("ch_name").alias("Name"),
        F.col("ch_description").alias("Description"),
        F.col("ch_subscribed").alias("Subcribed"),
        F.col("ch_keywords").alias("Keywords"),
        epoch_seconds(run_ts).alias("Timestamp"),
    )


def caption_rows(docs: DataFrame, run_ts: float | None = None, gate: str | None = None,
                 record: bool = False) -> DataFrame:
    """PRJ-3 / JOIN-4 / WIN-1: one row per caption track, ordinal key.

    The content is looked up by language code inside the same document
    (last duplicate code wins, as a dict keeps it) and parsed to VARIANT.
    """
    if gate:
        docs = docs.where(gate)
    if "video_id" not in docs.columns:
        docs = docs.withColumn("video_id", strict_video_id(F.col("vid_info.videoDetails.videoId")))
    exploded = docs.select("video_id", "captions", F.posexplode("caption_tracks").alias("pos", "t"))
    content = F.element_at(F.filter("captions", lambda c: c["code"] == F.col("t.code")), -1)
    key = F.concat_ws("_", "video_id", (F.col("pos") + 1).cast("string"))
    return exploded.select(
        *([key.alias(RECORD)] if record else []),
        key.alias("Contents_caption_id"),
        F.col("video_id").alias("VideoID"),
        F.col("t.name").alias("Language"),
        json_variant(content["json_captions"]).alias("Contents"),
        epoch_seconds(run_ts).alias("Timestamp"),
    )


def thumbnail_rows(docs: DataFrame, run_ts: float | None = None, gate: str | None = None,
                   record: bool = False) -> DataFrame:
    """PRJ-4 / WIN-1: one row per image; an empty list gives no rows."""
    if gate:
        docs = docs.where(gate)
    if "video_id" not in docs.columns:
        docs = docs.withColumn("video_id", strict_video_id(F.col("vid_info.videoDetails.videoId")))
    exploded = docs.select("video_id", F.posexplode("vid_info.videoDetails.thumbnail.thumbnails").alias("pos", "t"))
    key = F.concat_ws("_", "video_id", (F.col("pos") + 1).cast("string"))
    return exploded.select(
        *([key.alias(RECORD)] if record else []),
        key.alias("ThumbnailID"),
        F.col("video_id").alias("VideoID"),
        F.col("t.url").alias("URL"),
        F.col("t.width").alias("Width"),
        F.col("t.height").alias("Height"),
        epoch_seconds(run_ts).alias("Timestamp"),
    )


@dataclass
class Entities:
    joined: DataFrame
    video: DataFrame
    channel: DataFrame
    caption: DataFrame
    thumbnail: DataFrame

    run_ts: float | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {"video": self.video, "channel": self.channel, "caption": self.caption, "thumbnail": self.thumbnail}

    def landing_tables(self) -> dict[str, DataFrame]:
        """The four tables with their per-record landing key ``_record`` first."""
        j, ts = self.joined, self.run_ts
        return {
            "video": video_rows(j, ts, record=True),
            "channel": channel_rows(j, ts, record=True),
            "caption": caption_rows(j, ts, gate="emit_caption", record=True),
            "thumbnail": thumbnail_rows(j, ts, gate="emit_thumbnail", record=True),
        }

    def unpersist(self) -> None:
        self.joined.unpersist()


def extract_entities(videos: DataFrame, channels: DataFrame, run_ts: float | None = None,
                     persist: bool | str = False, hot_share: float | None = None, hot_buckets: int = 16,
                     distinct_videos: bool = False) -> Entities:
    """PRJ-7: parse once, feed four entity projections.

    ``persist=True`` (or ``"memory_and_disk"``) keeps the joined rows in
    executor storage, spilling to disk, so four writes share one scan +
    join; lost blocks are recomputed from the deterministic lineage.
    ``persist="checkpoint"`` instead stages them on reliable storage under
    ``spark.checkpoint.dir`` (lineage cut: a lost executor costs a re-read,
    not a re-join) -- the choice for very large runs on preemptible nodes.
    """
    j = join_documents(videos, channels, hot_share, hot_buckets, distinct_videos)
    if persist == "checkpoint":
        checkpoint_root(j.sparkSession)
        j = j.checkpoint(eager=True)
    elif persist:
        j = j.persist(StorageLevel.MEMORY_AND_DISK)
    return Entities(
        joined=j,
        video=video_rows(j, run_ts),
        channel=channel_rows(j, run_ts),
        caption=caption_rows(j, run_ts, gate="emit_caption"),
        thumbnail=thumbnail_rows(j, run_ts, gate="emit_thumbnail"),
        run_ts=run_ts,
    )


def fanout_counts(j: DataFrame) -> DataFrame:
    """Rows each stage emits (one aggregate pass over the joined rows)."""
    tracks = F.coalesce(F.size("caption_tracks"), F.lit(0))
    tracks = F.when(tracks < 0, 0).otherwise(tracks)
    thumbs = F.coalesce(F.size("vid_info.videoDetails.thumbnail.thumbnails"), F.lit(0))
    thumbs = F.when(thumbs < 0, 0).otherwise(thumbs)
    return j.agg(
        F.count_if("video_ok").cast("bigint").alias("n_video"),
        F.count_if("emit_channel").cast("bigint").alias("n_channel"),
        F.sum(F.when(F.col("emit_caption"), tracks).otherwise(0)).cast("bigint").alias("n_caption"),
        F.sum(F.when(F.col("emit_thumbnail"), thumbs).otherwise(0)).cast("bigint").alias("n_thumbnail"),
    )
