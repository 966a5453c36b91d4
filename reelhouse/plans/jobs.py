"""The twelve jobs as entry points (session from the caller, paths as arguments).

J1+J2  ``ingest_metadata``   raw documents -> four entity landings for one day
J3     ``load_warehouse``    one day's landings -> append tables + load report
J4     ``load_incremental``  new landing files -> append tables (stream, availableNow)
J5-J7  ``ingest_media``      eligible, not-yet-stored videos -> media copy + manifest
J8     ``export_query``      SQL text -> exact CSV parts
J9     ``gate``              SQL cell -> bool (re-exported)
J10    ``category_table``    saved category response -> (id, title)
J11    ``publish_queue``     queue table -> JSON requests
J12    ``channel_artwork``   channel documents -> artwork rows (re-exported)
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.lookups import SEARCH_TERM
from ..operators import eligibility, entities
from ..operators.gate import sql_gate as gate  # noqa: F401  (J9)
from ..operators.reference import categories, channel_artwork  # noqa: F401  (J10 / J12)
from ..sinks import export, landing, manifest, media, publish, warehouse
from ..sources import raw
from ..streaming import incremental

# Load order of the rebuilt loader DAG.
LOAD_ORDER = ("video", "channel", "thumbnail", "caption")
WIRE_SCHEMA = {"video": schemas.VIDEO, "channel": schemas.CHANNEL, "caption": schemas.CAPTION,
               "thumbnail": schemas.THUMBNAIL}


def ingest_metadata(spark: SparkSession, videos: DataFrame | str, channels: DataFrame | str, landing_base: str,
                    day=None, run_ts: float | None = None, first_page_only: bool = True, term: str = SEARCH_TERM,
                    stage: bool | str = True, hot_share: float | None = None,
                    parallel: int = 4) -> dict[str, str]:
    """J1 + J2: parse once, four projections, four day-partitioned landings.

    The joined rows are staged (``stage=True``: persisted; ``"checkpoint"``:
    reliable checkpoint) so the four writes share one scan and join.
    ``first_page_only`` keeps the first results page of ``term``; other documents are not ingested.
    ``hot_share`` turns on salting of channels above that share of videos.
    With staging, the four landings are written concurrently (``parallel``
    threads) from the staged rows. Returns the landing folder per entity.
    """
    v = raw.read_raw_videos(spark, videos) if isinstance(videos, str) else videos
    c = raw.read_raw_channels(spark, channels) if isinstance(channels, str) else channels
    if first_page_only:
        v = raw.first_page(v, term)
    ent = entities.extract_entities(v, c, run_ts=run_ts, persist=stage, hot_share=hot_share,
                                    distinct_videos=True)
    day = landing.day_text(day) if day is not None else landing.today_text(spark)
    tables = ent.landing_tables()
    try:
        if stage and parallel > 1:
            ent.joined.count()   # fill the staged rows once; the four writes then read them together
        # Records keep their identity: re-running a day replaces only the records landed again. All entities become visible at once.
        folders = [landing.day_folder(name, day) for name in tables]
        change = manifest.Change(spark, landing_base, folders)

        def land_one(name: str) -> str:
            return landing.land(tables[name], landing_base, name, day=day, merge=True, change=change)

        with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(tables)))) as pool:
            landed = dict(zip(tables, pool.map(land_one, tables), strict=True))
        change.commit()
        manifest.vacuum(spark, landing_base, folders)
        return landed
    finally:
        ent.unpersist()


def load_warehouse(spark: SparkSession, landing_base: str, warehouse_base: str, day: str,
                   order: tuple[str, ...] = LOAD_ORDER, fail_fast: bool = False,
                   parallel: int = 4) -> DataFrame:
    """J3: strict load of one day for each entity; returns the union of the load reports.

    The entity loads are independent Spark jobs; up to ``parallel`` of them
    are submitted at once (threads sharing the session's scheduler), so
    small loads share the cluster instead of queueing behind each other.
    ``fail_fast`` loads strictly one after another in ``order``.
    The loads are one change of the warehouse's manifest: ``warehouse.read_table`` sees all four or, if the run is lost, none.
    """
    day = landing.day_text(day)
    change = manifest.Change(spark, warehouse_base, order)

    def load_one(name: str) -> DataFrame:
        src = landing.entity_dir(landing_base, name)
        _, report = warehouse.strict_load(spark, src, WIRE_SCHEMA[name],
                                          table_path=f"{warehouse_base.rstrip('/')}/{name}", day=day,
                                          fail_fast=fail_fast)
        return report.withColumn("entity", F.lit(name))

    if fail_fast or parallel <= 1:
        reports = [load_one(n) for n in order]
    else:
        with ThreadPoolExecutor(max_workers=min(parallel, len(order))) as pool:
            reports = list(pool.map(load_one, order))
    change.commit()
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def load_incremental(spark: SparkSession, landing_base: str, warehouse_base: str, checkpoint_base: str, name: str) -> int:
    """J4: append records of landing files not seen by earlier runs (stream, availableNow).

    Every file is checked as in the batch load. Records are taken once per
    (record, day), in whatever order the days arrive: a same-day re-run that
    rewrote the day's files does not append the records it kept. Returns the rows written.
    """
    return incremental.load_new_records(spark, landing.entity_dir(landing_base, name), WIRE_SCHEMA[name],
                                        f"{warehouse_base.rstrip('/')}/{name}_stream", f"{checkpoint_base.rstrip('/')}/{name}")


def ingest_media(spark: SparkSession, videos: DataFrame, bucket_root: str, media_root: str, dest_root: str,
                 source: str = "clips", scope: str | None = None, run_ts=None) -> DataFrame:
    """J5-J7: eligible videos (not restricted, has itag 22, not stored) -> copy their media files.

    ``videos`` carries ``video_id, age_restricted, streams``; media files are
    named ``<video_id>.mp4`` under ``media_root``. Returns the manifest of the
    copied files.
    """
    listing = media.list_objects(spark, bucket_root)
    # Object names relative to the bucket root (\Q..\E quotes the root inside the regex).
    root_text = bucket_root.rstrip("/").split("://")[-1]
    rel = F.regexp_replace(F.col("path"), "^.*?\\Q" + root_text + "\\E/", "")
    names = eligibility.in_scope(listing.select(rel.alias("path")), scope=scope)
    ok = eligibility.eligible(videos, names).select("video_id")
    files = media.list_objects(spark, media_root, glob="*.mp4")     # names and lengths only
    chosen = files.join(ok, F.regexp_extract(files["path"], r"([^/]*)\.mp4$", 1) == ok["video_id"], "left_semi")
    return media.copy_objects(media.manifest(chosen, source, media._ts(run_ts)), dest_root)


def export_query(spark: SparkSession, sql: str, out_dir: str, file_name: str, args: dict | None = None,
                 **kwargs) -> export.ExportResult:
    """J8: SQL text -> CSV parts of an exact size."""
    return export.export_sql(spark, sql, out_dir, file_name, args=args, **kwargs)


def category_table(spark: SparkSession, response_path: str) -> DataFrame:
    """J10: saved category response(s) (JSON) -> (id, title)."""
    return categories(spark.read.schema(schemas.CATEGORY_RESPONSE).json(response_path))


def publish_queue(queue: DataFrame, now=None) -> DataFrame:
    """J11: queue rows -> publish request JSON."""
    return publish.publish_requests(queue, now=now)
