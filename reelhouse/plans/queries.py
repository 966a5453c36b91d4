"""Driver queries: each job run on stand-in inputs derived from the test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB
SQL over the same parquet tables) must agree on row count, column names and
values. Every query reads whole tables; jobs that write (landing, load,
export, streams) write under a fresh folder of the shared checkpoint root
and return what Spark reads back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs
from ..operators import eligibility, entities, gate, reference
from ..schemas import CATEGORY_RESPONSE, legacy
from ..session import work_dir
from ..sinks import export, landing, media, publish, warehouse
from ..sources import landed, raw
from ..sources.sql import register_tables
from ..streaming import incremental
from . import standins
from .jobs import WIRE_SCHEMA, export_query, ingest_metadata, load_warehouse
from .standins import RUN_TS

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
RUN_TS_SQL = "CAST(1704067200.0 AS DOUBLE)"
RUN_NTZ = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
HREF = r'href="([^"]*)"'

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _entities(spark: SparkSession, d: str) -> entities.Entities:
    return entities.extract_entities(standins.video_docs(t(spark, d, "orders")),
                                     standins.channel_docs(t(spark, d, "customer")), run_ts=RUN_TS)


# Shared oracle fragments -----------------------------------------------------------
_VIDEO_JOIN = """
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE coalesce(o.o_orderstatus <> 'P', false) AND o.o_orderdate IS NOT NULL
"""
_THUMB_UNNEST = f"""
WITH h AS (SELECT page_id, regexp_extract_all(html, '{HREF}', 1) AS arr FROM pages),
u AS (SELECT page_id, unnest(arr) AS url, unnest(generate_series(1, len(arr))) AS pos FROM h)
"""


def _ymd(col: str, sep: str) -> str:
    return (f"CAST(year({col}) AS VARCHAR) || '{sep}' || CAST(month({col}) AS VARCHAR) || '{sep}' || "
            f"CAST(day({col}) AS VARCHAR)")


# J1 entity extraction ----------------------------------------------------------------
@query("video_rows", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS VideoID, 'C' || CAST(o.o_custkey AS VARCHAR) AS ChannelID,
       o.o_custkey AS Length, {_ymd('o.o_orderdate', '/')} AS Publish_date, o.o_orderpriority AS Title,
       o.o_orderkey AS Views, CAST(NULL AS VARCHAR) AS Description, {RUN_TS_SQL} AS Timestamp
{_VIDEO_JOIN}""")
def video_rows(spark, d):
    return _entities(spark, d).video


@query("video_rows_salted", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS VideoID, 'C' || CAST(o.o_custkey AS VARCHAR) AS ChannelID,
       o.o_custkey AS Length, {_ymd('o.o_orderdate', '/')} AS Publish_date, o.o_orderpriority AS Title,
       o.o_orderkey AS Views, CAST(NULL AS VARCHAR) AS Description, {RUN_TS_SQL} AS Timestamp
{_VIDEO_JOIN}""")
def video_rows_salted(spark, d):
    """J1 with hot channels (>= 0.1% of all videos) split over 8 salted tasks."""
    ent = entities.extract_entities(standins.video_docs(t(spark, d, "orders")),
                                    standins.channel_docs(t(spark, d, "customer")), run_ts=RUN_TS,
                                    hot_share=0.001, hot_buckets=8)
    return ent.video


@query("channel_rows_per_video", f"""
SELECT 'C' || CAST(c.c_custkey AS VARCHAR) AS ChannelID,
       'https://video.example.com/channel/C' || CAST(c.c_custkey AS VARCHAR) AS URL, c.c_name AS Name,
       c.c_mktsegment AS Description, CAST(c.c_nationkey AS VARCHAR) AS Subcribed, c.c_name AS Keywords,
       {RUN_TS_SQL} AS Timestamp
{_VIDEO_JOIN} AND coalesce(c.c_mktsegment <> 'HOUSEHOLD', false)""")
def channel_rows_per_video(spark, d):
    return _entities(spark, d).channel


@query("caption_rows", f"""
WITH ok AS (SELECT o.* {_VIDEO_JOIN} AND coalesce(c.c_mktsegment <> 'HOUSEHOLD', false)
            AND coalesce(o.o_orderpriority <> '5-LOW', false))
SELECT CAST(o_orderkey AS VARCHAR) || '_1' AS Contents_caption_id, CAST(o_orderkey AS VARCHAR) AS VideoID,
       o_orderpriority AS Language, o_orderkey AS content_k, {RUN_TS_SQL} AS Timestamp FROM ok
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR) || '_2', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_custkey, {RUN_TS_SQL}
FROM ok""")
def caption_rows(spark, d):
    cap = _entities(spark, d).caption
    return cap.select("Contents_caption_id", "VideoID", "Language",
                      F.variant_get("Contents", "$.k", "bigint").alias("content_k"), "Timestamp")


@query("thumbnail_rows", f"""{_THUMB_UNNEST}
SELECT CAST(page_id AS VARCHAR) || '_' || CAST(pos AS VARCHAR) AS ThumbnailID, CAST(page_id AS VARCHAR) AS VideoID,
       url AS URL, CAST(length(url) AS BIGINT) AS Width, CAST(pos AS BIGINT) AS Height, {RUN_TS_SQL} AS Timestamp
FROM u""")
def thumbnail_rows(spark, d):
    return entities.thumbnail_rows(standins.page_image_docs(t(spark, d, "pages")), RUN_TS)


@query("entity_fanout_counts", f"""
WITH f AS (
  SELECT coalesce(o.o_orderstatus <> 'P', false) AND o.o_orderdate IS NOT NULL AS v_ok,
         coalesce(c.c_mktsegment <> 'HOUSEHOLD', false) AS ch_ok,
         coalesce(o.o_orderpriority <> '5-LOW', false) AS cap_ok,
         coalesce(o.o_orderpriority <> '4-NOT SPECIFIED', false) AS th_ok
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT CAST(count(*) FILTER (WHERE v_ok) AS BIGINT) AS n_video,
       CAST(count(*) FILTER (WHERE v_ok AND ch_ok) AS BIGINT) AS n_channel,
       CAST(2 * count(*) FILTER (WHERE v_ok AND ch_ok AND cap_ok) AS BIGINT) AS n_caption,
       CAST(2 * count(*) FILTER (WHERE v_ok AND ch_ok AND cap_ok AND th_ok) AS BIGINT) AS n_thumbnail
FROM f""")
def entity_fanout_counts(spark, d):
    return entities.fanout_counts(_entities(spark, d).joined)


@query("video_descriptions", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS VideoID, 'C' || CAST(o.o_custkey AS VARCHAR) AS ChannelID, o.o_orderkey AS Views,
       CASE WHEN o.o_orderstatus <> 'O' THEN o.o_orderpriority END AS Description
{_VIDEO_JOIN} AND o.o_orderpriority <> '3-MEDIUM'""")
def video_descriptions(spark, d):
    """J1 with channels that list their videos: the last item's text, null texts, and items without a text run (which fail the stage)."""
    orders = t(spark, d, "orders")
    channels = standins.channel_docs(t(spark, d, "customer"), standins.order_items(orders))
    ent = entities.extract_entities(standins.video_docs(orders), channels, run_ts=RUN_TS)
    return ent.video.select("VideoID", "ChannelID", "Views", "Description")


@query("duplicate_documents", f"""
SELECT count(*) AS n_rows, count(DISTINCT o.o_orderkey) AS n_videos, min(o.o_orderkey) AS first_views, max(o.o_orderkey) AS last_views
{_VIDEO_JOIN}""")
def duplicate_documents(spark, d):
    """Every video and channel document occurs twice with a different title and name: each video has one row."""
    videos, channels = standins.video_docs(t(spark, d, "orders")), standins.channel_docs(t(spark, d, "customer"))
    videos = videos.unionByName(videos.withColumn("title", F.concat("title", F.lit(" again"))))
    channels = channels.unionByName(channels.withColumn("channel_name", F.concat("channel_name", F.lit(" again"))))
    video = entities.extract_entities(videos, channels, run_ts=RUN_TS, distinct_videos=True).video
    return video.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("VideoID").alias("n_videos"),
                     F.min("Views").alias("first_views"), F.max("Views").alias("last_views"))


@query("description_lookup", """
SELECT conv_id, role AS video_id, arg_max(text, turn) AS description
FROM conversations WHERE role IS NOT NULL GROUP BY conv_id, role""")
def description_lookup(spark, d):
    items = t(spark, d, "conversations")
    out = entities.lookup_descriptions(items, channel_key="conv_id", video_key="role", pos="turn",
                                       text="text", missing=None)
    return out.select("conv_id", F.col("role").alias("video_id"), "description")


@query("caption_json_field", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def caption_json_field(spark, d):
    ev = t(spark, d, "events")
    return ev.select("event_id", F.variant_get(exprs.json_variant("props"), "$.k", "bigint").alias("k"))


@query("fatal_missing_id", """
SELECT CAST(event_id AS VARCHAR) AS video_id,
       'https://www.youtube.com/watch?v=' || CAST(event_id AS VARCHAR) AS video_url FROM events""")
def fatal_missing_id(spark, d):
    ev = t(spark, d, "events")
    feed = ev.select(F.struct(F.struct(F.col("event_id").cast("string").alias("videoId")).alias("videoDetails"))
                     .alias("vid_info"))
    out = raw.with_video_id(feed)
    return out.select("video_id", exprs.watch_url("video_id").alias("video_url"))


@query("first_page_feed", """
SELECT doc_id, source, CAST(1 AS INTEGER) AS page FROM documents
WHERE lang = 'en' AND n_chars >= 0 AND n_chars < 1000""")
def first_page_feed(spark, d):
    docs = t(spark, d, "documents")
    feed = docs.select("doc_id", "source", F.col("lang").alias("search_term"),
                       (F.floor(F.col("n_chars") / 1000) + 1).cast("int").alias("page"))
    return raw.first_page(feed, term="en").select("doc_id", "source", "page")


@query("channel_artwork_rows", """
SELECT CAST(NULL AS VARCHAR) AS VideoID, 'C' || CAST(c_custkey AS VARCHAR) AS ChannelID, 'avatar' AS Type,
       'https://yt3.example.com/a/' || CAST(c_custkey AS VARCHAR) AS URL, CAST(88 AS BIGINT) AS Width,
       CAST(88 AS BIGINT) AS Height, CAST(1 AS BIGINT) AS ordinal FROM customer
UNION ALL
SELECT NULL, 'C' || CAST(c_custkey AS VARCHAR), 'banner', lower(c_name), c_custkey, CAST(c_nationkey AS BIGINT), 2
FROM customer
UNION ALL
SELECT NULL, 'C' || CAST(c_custkey AS VARCHAR), 'banner', upper(c_name), CAST(c_nationkey AS BIGINT), c_custkey, 3
FROM customer""")
def channel_artwork_rows(spark, d):
    return reference.channel_artwork(standins.channel_docs(t(spark, d, "customer")))


@query("category_flatten", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title FROM part
UNION ALL SELECT p_brand, p_type FROM part""")
def category_flatten(spark, d):
    part = t(spark, d, "part")
    items = F.array(
        F.struct(F.col("p_partkey").cast("string").alias("id"), F.struct(F.col("p_name").alias("title")).alias("snippet")),
        F.struct(F.col("p_brand").alias("id"), F.struct(F.col("p_type").alias("title")).alias("snippet")),
    )
    payload = part.select(F.to_json(F.struct(items.alias("items"))).alias("value"))
    responses = payload.select(F.from_json("value", CATEGORY_RESPONSE).alias("r")).select("r.*")
    return reference.categories(responses)


@query("metadata_end_to_end", f"""
WITH f AS (
  SELECT coalesce(o.o_orderstatus <> 'P', false) AND o.o_orderdate IS NOT NULL AS v_ok,
         coalesce(c.c_mktsegment <> 'HOUSEHOLD', false) AS ch_ok,
         coalesce(o.o_orderpriority <> '5-LOW', false) AS cap_ok,
         coalesce(o.o_orderpriority <> '4-NOT SPECIFIED', false) AS th_ok
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
n AS (
  SELECT count(*) FILTER (WHERE v_ok) AS v, count(*) FILTER (WHERE v_ok AND ch_ok) AS ch,
         2 * count(*) FILTER (WHERE v_ok AND ch_ok AND cap_ok) AS cap,
         2 * count(*) FILTER (WHERE v_ok AND ch_ok AND cap_ok AND th_ok) AS th FROM f)
SELECT 'video' AS entity, CAST(v AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_failed_files FROM n
UNION ALL SELECT 'channel', CAST(ch AS BIGINT), 0 FROM n
UNION ALL SELECT 'caption', CAST(cap AS BIGINT), 0 FROM n
UNION ALL SELECT 'thumbnail', CAST(th AS BIGINT), 0 FROM n""")
def metadata_end_to_end(spark, d):
    """J1 -> J2 -> J3: extract, land one day, strict-load into the four tables."""
    root = work_dir(spark, "e2e")
    ingest_metadata(spark, standins.video_docs(t(spark, d, "orders")), standins.channel_docs(t(spark, d, "customer")),
                    root + "/landing", day="2024-1-1", run_ts=RUN_TS)
    report = load_warehouse(spark, root + "/landing", root + "/warehouse", day="2024-1-1")
    failed = report.groupBy("entity").agg(F.count_if(F.col("status") == "failed").cast("bigint").alias("n_failed_files"))
    counts = None
    for name in WIRE_SCHEMA:
        c = spark.read.parquet(f"{root}/warehouse/{name}").agg(F.count(F.lit(1)).alias("n_rows")) \
            .withColumn("entity", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    return counts.join(failed, "entity", "left").select(
        "entity", "n_rows", F.coalesce("n_failed_files", F.lit(0)).cast("bigint").alias("n_failed_files"))


@query("landing_same_day_rerun", f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS VideoID, 'C' || CAST(o.o_custkey AS VARCHAR) AS ChannelID,
       o.o_custkey AS Length, {_ymd('o.o_orderdate', '/')} AS Publish_date, o.o_orderpriority AS Title,
       o.o_orderkey AS Views, CAST(NULL AS VARCHAR) AS Description, {RUN_TS_SQL} AS Timestamp
{_VIDEO_JOIN}""")
def landing_same_day_rerun(spark, d):
    """Two ingests on one day (open orders first, then every order), one load: each video once."""
    root = work_dir(spark, "rerun")
    orders, chans = t(spark, d, "orders"), standins.channel_docs(t(spark, d, "customer"))
    for batch in (orders.where("o_orderstatus = 'O'"), orders):
        ingest_metadata(spark, standins.video_docs(batch), chans, root + "/landing", day="2024-1-1", run_ts=RUN_TS)
    load_warehouse(spark, root + "/landing", root + "/warehouse", day="2024-1-1")
    return spark.read.parquet(root + "/warehouse/video")


# J2 landing / J3 load / J4 incremental ---------------------------------------------------
_EVENT_DAY = _ymd("ts", "-")


@query("landing_rerun_keeps_failed", """
SELECT sum(CASE WHEN lang <> 'de' THEN 1 ELSE 0 END)::BIGINT AS n_loaded, sum(CASE WHEN lang = 'de' THEN 1 ELSE 0 END)::BIGINT AS n_refused
FROM documents""")
def landing_rerun_keeps_failed(spark, d):
    """A day with refused files ('de' lines carry an unexpected field) is landed again in part: they stay refused, all else loads once."""
    base, table = work_dir(spark, "rerun"), work_dir(spark, "rerun-table")
    docs = t(spark, d, "documents").select(F.col("doc_id").cast("string").alias(landing.RECORD), "doc_id", "text", "lang", "n_chars")
    good, bad = docs.where("lang <> 'de'"), docs.where("lang = 'de'").withColumn("unexpected", F.lit("x"))
    target = landing.land(good, base, "video", day="2024-1-1")
    bad.write.mode("append").json(f"{target}/{landing.DAY_COL}=2024-1-1")
    landing.land(good.where("lang <> 'en'"), base, "video", day="2024-01-01", merge=True)
    rows, report = warehouse.strict_load(spark, target, _DOC_SCHEMA, table_path=table, day="2024-1-1")
    zero = F.lit(0).cast("bigint")
    both = (spark.read.parquet(table).groupBy().agg(F.count(F.lit(1)).alias("n_loaded")).select("n_loaded", zero.alias("n_refused"))
            .unionByName(report.where("status = 'failed'").select(zero.alias("n_loaded"), F.col("n_rows").alias("n_refused"))))
    return both.agg(F.sum("n_loaded").alias("n_loaded"), F.sum("n_refused").alias("n_refused"))


@query("landing_paths", f"""
SELECT event_id, 'Metadata/Video/' || {_EVENT_DAY} || '/' || {_EVENT_DAY} || '_metadata_Video_'
       || CAST(event_id AS VARCHAR) || '_1.json' AS path FROM events""")
def landing_paths(spark, d):
    ev = t(spark, d, "events")
    day = exprs.dash_date("ts")
    return ev.select("event_id", landing.landing_path("video", day, F.col("event_id").cast("string"), F.lit(1))
                     .alias("path"))


def _events_schema(spark, d) -> T.StructType:
    return t(spark, d, "events").schema


@query("landing_overwrite_same_day", f"""
SELECT {_EVENT_DAY} AS ingest_date, count(*) AS n_rows FROM events GROUP BY 1""")
def landing_overwrite_same_day(spark, d):
    base = work_dir(spark, "landing")
    ev = t(spark, d, "events")
    landing.land(ev, base, "video", ts_col="ts")
    landing.land(ev, base, "video", ts_col="ts")  # same days again: replaced, not doubled
    back = landed.read_day(spark, landing.entity_dir(base, "video"), _events_schema(spark, d))
    return back.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("date_prefix_load", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-01'""")
def date_prefix_load(spark, d):
    base = work_dir(spark, "prefix")
    landing.land(t(spark, d, "events"), base, "video", ts_col="ts")
    back = landed.read_day(spark, landing.entity_dir(base, "video"), _events_schema(spark, d), day="2024-1-1")
    return back.drop("ingest_date")


@query("legacy_layout_rows", f"""{_THUMB_UNNEST}
SELECT CAST(page_id AS VARCHAR) || '_' || CAST(pos AS VARCHAR) AS ThumbnailID, CAST(page_id AS VARCHAR) AS VideoID,
       url AS URL, CAST(length(url) AS BIGINT) AS Width, CAST(pos AS BIGINT) AS Height
FROM u""")
def legacy_layout_rows(spark, d):
    base = work_dir(spark, "legacy")
    rows = entities.thumbnail_rows(standins.page_image_docs(t(spark, d, "pages")), RUN_TS)
    target = landing.land_legacy(rows, base, "thumbnail")
    return spark.read.schema(legacy("thumbnail")).json(target)


@query("legacy_layout_entities", f"""
WITH v AS (SELECT o.*, c.c_mktsegment {_VIDEO_JOIN}),
     cap AS (SELECT * FROM v WHERE coalesce(c_mktsegment <> 'HOUSEHOLD', false) AND coalesce(o_orderpriority <> '5-LOW', false))
SELECT 'video' AS entity, 'VideoID,ChannelID,Length,Publish_date,Title,Views,Description' AS columns, count(*) AS n_rows,
       count(DISTINCT o_orderkey) AS n_keys FROM v
UNION ALL SELECT 'channel', 'ChannelID,URL,Name,Description,Subcribed,Keywords', count(*), count(DISTINCT o_custkey) FROM v
  WHERE coalesce(c_mktsegment <> 'HOUSEHOLD', false)
UNION ALL SELECT 'caption', 'Caption_id,VideoID,Language,Contents', 2 * count(*), 2 * count(DISTINCT o_orderkey) FROM cap
UNION ALL SELECT 'thumbnail', 'ThumbnailID,VideoID,URL,Width,Height', 2 * count(*), 2 * count(DISTINCT o_orderkey) FROM cap
  WHERE coalesce(o_orderpriority <> '4-NOT SPECIFIED', false)""")
def legacy_layout_entities(spark, d):
    """All four entities in the older layout, written twice (the second run overwrites) and read back."""
    base, ent = work_dir(spark, "legacy-all"), _entities(spark, d)
    out = None
    for name, df in ent.tables().items():
        for _ in range(2):
            target = landing.land_legacy(df, base, name)
        back = spark.read.schema(legacy(name)).json(target)
        one = back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(back.columns[0]).alias("n_keys")).select(
            F.lit(name).alias("entity"), F.lit(",".join(back.columns)).alias("columns"), "n_rows", "n_keys")
        out = one if out is None else out.unionByName(one)
    return out


@query("append_twice", """
SELECT * FROM customer UNION ALL SELECT * FROM customer""")
def append_twice(spark, d):
    table = work_dir(spark, "append") + "/customer"
    cust = t(spark, d, "customer")
    warehouse.append(cust, table)
    warehouse.append(cust, table)  # a re-run appends again (append-only log)
    return spark.read.parquet(table)


_DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def _land_documents_with_faults(spark, d) -> str:
    """Documents as NDJSON, one file per (source, language); 'de' lines carry an
    unexpected field, so exactly the 'de' files must fail the strict load."""
    base = work_dir(spark, "strict")
    docs = t(spark, d, "documents")
    lines = docs.select("doc_id", "text", "lang", "n_chars",
                        F.when(F.col("lang") == "de", F.lit("x")).alias("unexpected"),
                        "source", F.col("lang").alias("lang_dir"))
    lines.repartition("source", "lang_dir").write.mode("overwrite").partitionBy("source", "lang_dir").json(base)
    return base


@query("strict_load_report", """
SELECT source, lang, count(*) AS n_rows, count(*) FILTER (WHERE lang = 'de') AS n_bad,
       CASE WHEN count(*) FILTER (WHERE lang = 'de') = 0 THEN 'loaded' ELSE 'failed' END AS status
FROM documents GROUP BY source, lang""")
def strict_load_report(spark, d):
    base = _land_documents_with_faults(spark, d)
    _, report = warehouse.strict_load(spark, base, _DOC_SCHEMA)
    return report.select(F.regexp_extract("file_path", r"source=([^/]+)", 1).alias("source"),
                         F.regexp_extract("file_path", r"lang_dir=([^/]+)", 1).alias("lang"),
                         "n_rows", "n_bad", "status")


@query("strict_load_rows", """
SELECT doc_id, text, lang, n_chars FROM documents WHERE lang <> 'de'""")
def strict_load_rows(spark, d):
    base = _land_documents_with_faults(spark, d)
    table = work_dir(spark, "strict-table")
    warehouse.strict_load(spark, base, _DOC_SCHEMA, table_path=table)
    return spark.read.parquet(table)


@query("incremental_load", """SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def incremental_load(spark, d):
    root = work_dir(spark, "incr")
    ev = t(spark, d, "events")
    landing.land(ev, root + "/landing", "video", ts_col="ts")
    src = landing.entity_dir(root + "/landing", "video")
    schema = incremental.with_day_column(ev.schema)
    for _ in range(2):  # the second run finds no new file and appends nothing
        incremental.load_new_files(spark, src, schema, root + "/table", root + "/ckpt")
    return spark.read.parquet(root + "/table").drop("ingest_date", incremental.BATCH_COL)


@query("incremental_late_day", """SELECT event_id, ts, user_id, event_type, value, props FROM events""")
def incremental_late_day(spark, d):
    """Later days are landed and loaded before the first one, which is landed twice; every row is loaded once."""
    root = work_dir(spark, "late")
    ev = t(spark, d, "events")
    records = ev.withColumn(landing.RECORD, F.col("event_id").cast("string"))
    first_day = F.to_date("ts") <= F.lit("2024-01-01").cast("date")
    for arrival in (records.where(~first_day), records.where(first_day), records.where(first_day)):
        landing.land(arrival, root, "video", ts_col="ts")
        incremental.load_new_records(spark, landing.entity_dir(root, "video"), ev.schema, root + "/table", root + "/ckpt")
    return spark.read.parquet(root + "/table").select(*ev.columns)


@query("incremental_strict", """
SELECT '2024-1-' || CASE lang WHEN 'de' THEN '1' WHEN 'en' THEN '2' WHEN 'es' THEN '3' ELSE '4' END AS ingest_date,
       count(*) FILTER (WHERE lang <> 'de') AS n_loaded, bool_or(lang = 'de') AS failed
FROM documents GROUP BY 1""")
def incremental_strict(spark, d):
    """Documents landed by language as days; 'de' lines carry an unexpected field, so its files load nothing and are reported."""
    root = work_dir(spark, "incr-strict")
    docs = t(spark, d, "documents")
    lang = F.col("lang")
    day = F.concat(F.lit("2024-1-"), F.when(lang == "de", "1").when(lang == "en", "2").when(lang == "es", "3").otherwise("4"))
    lines = docs.select("doc_id", "text", "lang", "n_chars", F.when(lang == "de", F.lit("x")).alias("unexpected"), day.alias(landing.DAY_COL))
    lines.write.partitionBy(landing.DAY_COL).json(root + "/landing")
    incremental.load_new_records(spark, root + "/landing", _DOC_SCHEMA, root + "/table", root + "/ckpt")
    rows = spark.read.parquet(root + "/table").groupBy(landing.DAY_COL).agg(F.count(F.lit(1)).alias("n"))
    report = spark.read.parquet(root + "/table_load_report").groupBy(landing.DAY_COL).agg(F.bool_and(F.col("status") == "failed").alias("failed"))
    return report.join(rows, landing.DAY_COL, "left").select(landing.DAY_COL, F.coalesce("n", F.lit(0)).alias("n_loaded"), "failed")


def _dedup_two_arrivals(spark, d, mode: str) -> DataFrame:
    root = work_dir(spark, "dedup")
    conv = t(spark, d, "conversations")
    for batch in (conv.where("turn < 4"), conv.where("turn >= 4")):  # two arrivals
        batch.write.mode("append").json(root + "/src")
        incremental.load_new_files(spark, root + "/src", conv.schema, root + "/table", root + "/ckpt",
                                   dedup_keys=["conv_id"], dedup_mode=mode)
    return spark.read.parquet(root + "/table").select("conv_id")


@query("skip_already_stored", """SELECT DISTINCT conv_id FROM conversations""")
def skip_already_stored(spark, d):
    """STR-2 with the seen keys in the stream's state store."""
    return _dedup_two_arrivals(spark, d, "state")


@query("skip_already_stored_target", """SELECT DISTINCT conv_id FROM conversations""")
def skip_already_stored_target(spark, d):
    """STR-2 without state: each micro-batch is anti-joined with the target's keys."""
    return _dedup_two_arrivals(spark, d, "target")


# J5 / J6 eligibility --------------------------------------------------------------------
_DOC_KEY_SQL = "'/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR)"
_NOT_STORED_SQL = f"""
SELECT d.doc_id, {_DOC_KEY_SQL} AS video_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE contains(p.url, {_DOC_KEY_SQL}))"""


def _doc_candidates(spark, d) -> DataFrame:
    docs = t(spark, d, "documents")
    return docs.select("doc_id", F.concat(F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
                       .alias("video_id"), "n_chars")


def _listing(spark, d) -> DataFrame:
    return t(spark, d, "pages").select(F.col("url").alias("path"))


@query("not_stored_contains", _NOT_STORED_SQL)
def not_stored_contains(spark, d):
    """The ``contains`` rule: names probed with a Bloom filter of the keys, then an equality join (no nested loop)."""
    return eligibility.not_stored(_doc_candidates(spark, d), _listing(spark, d)) \
        .select("doc_id", "video_id")


@query("not_stored_ngram", _NOT_STORED_SQL)
def not_stored_ngram(spark, d):
    """The same rule without Python: all substrings of the key lengths, then the equality join."""
    return eligibility.not_stored(_doc_candidates(spark, d), _listing(spark, d), method="grams") \
        .select("doc_id", "video_id")


@query("eligible_videos", f"""
WITH tox AS (SELECT doc_id, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id)
SELECT d.doc_id, {_DOC_KEY_SQL} AS video_id FROM documents d LEFT JOIN tox ON tox.doc_id = d.doc_id
WHERE NOT (coalesce(tox.toxic, false) OR NOT coalesce(d.n_chars > 100, false)
           OR EXISTS (SELECT 1 FROM pages p WHERE contains(p.url, {_DOC_KEY_SQL})))""")
def eligible_videos(spark, d):
    tox = t(spark, d, "labels").groupBy("doc_id").agg(F.bool_or(F.col("toxic") == 1).alias("age_restricted"))
    cand = _doc_candidates(spark, d).join(tox, "doc_id", "left").withColumn(
        "streams", F.array(F.struct(
            F.when(F.col("n_chars") > 100, F.lit(22)).otherwise(F.lit(18)).alias("itag"),
            F.lit(True).alias("progressive"), F.lit("mp4").alias("file_extension"))))
    return eligibility.eligible(cand, _listing(spark, d)).select("doc_id", "video_id")


@query("eligibility_reasons", f"""
WITH tox AS (SELECT doc_id, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT coalesce(tox.toxic, false) AS r,
             EXISTS (SELECT 1 FROM pages p WHERE contains(p.url, {_DOC_KEY_SQL})) AS s,
             NOT coalesce(d.n_chars > 100, false) AS n
      FROM documents d LEFT JOIN tox ON tox.doc_id = d.doc_id)
SELECT NULLIF(concat_ws(',', CASE WHEN r THEN 'age_restricted' END, CASE WHEN s THEN 'already_stored' END,
                        CASE WHEN n THEN 'no_itag_22' END), '') AS reject_reason,
       count(*) AS n_videos
FROM c GROUP BY 1""")
def eligibility_reasons(spark, d):
    tox = t(spark, d, "labels").groupBy("doc_id").agg(F.bool_or(F.col("toxic") == 1).alias("age_restricted"))
    cand = _doc_candidates(spark, d).join(tox, "doc_id", "left").withColumn(
        "streams", F.array(F.struct(
            F.when(F.col("n_chars") > 100, F.lit(22)).otherwise(F.lit(18)).alias("itag"),
            F.lit(True).alias("progressive"), F.lit("mp4").alias("file_extension"))))
    out = eligibility.classify(cand, eligibility.in_scope(_listing(spark, d), scope=None))
    return out.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_videos"))


@query("has_stream", """
SELECT l_orderkey, NOT coalesce(bool_or(l_linenumber = 2 AND l_returnflag <> 'R' AND l_linestatus = 'O'), false)
       AS no_itag_22
FROM lineitem GROUP BY l_orderkey""")
def has_stream(spark, d):
    """Stream lists from the lines of an order: line 2 is itag 22; returned ones are not progressive, others than 'O' no mp4."""
    stream = F.struct(F.when(F.col("l_linenumber") == 2, 22).otherwise(18).alias("itag"),
                      (F.col("l_returnflag") != "R").alias("progressive"),
                      F.when(F.col("l_linestatus") == "O", "mp4").otherwise("webm").alias("file_extension"))
    streams = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(stream).alias("streams"))
    return streams.select("l_orderkey", eligibility.no_itag_22("streams").alias("no_itag_22"))


@query("any_all_flags", """
SELECT o_custkey, bool_or(o_orderstatus = 'F') AS any_flag, bool_and(o_totalprice > 1000) AS all_flag
FROM orders GROUP BY o_custkey""")
def any_all_flags(spark, d):
    o = t(spark, d, "orders")
    return eligibility.any_all_flags(o, "o_custkey", F.col("o_orderstatus") == "F", F.col("o_totalprice") > 1000)


@query("parity_filters", """
SELECT event_type, count(*) FILTER (WHERE minute(ts) % 2 = 0) AS n_even_minute,
       count(*) FILTER (WHERE event_id % 2 <> 0) AS n_odd_id
FROM events GROUP BY event_type""")
def parity_filters(spark, d):
    ev = t(spark, d, "events")
    return ev.groupBy("event_type").agg(F.count_if(exprs.is_even_minute("ts")).cast("bigint").alias("n_even_minute"),
                                        F.count_if(exprs.is_odd("event_id")).cast("bigint").alias("n_odd_id"))


# J7 media --------------------------------------------------------------------------------
_BASE = "regexp_extract(url, '([^/]*)$', 1)"
_HEAD = "regexp_extract(url, '^(.*/)', 1)"


@query("media_manifest", f"""
SELECT page_id, url AS src_path,
       'Video/clips/2024-01-01/2024-01-01 00:00:00_' || {_BASE} AS dest_path,
       CASE lower(regexp_extract({_BASE}, '\\.([^.]*)$', 1)) WHEN 'json' THEN 'application/json'
            WHEN 'mp4' THEN 'video/mp4' ELSE 'application/octet-stream' END AS content_type,
       CAST(length(html) AS BIGINT) AS length,
       {_BASE} AS base_name,
       CASE WHEN {_HEAD} = '' THEN '' WHEN regexp_replace({_HEAD}, '/+$', '') = '' THEN {_HEAD}
            ELSE regexp_replace({_HEAD}, '/+$', '') END AS dir_name
FROM pages""")
def media_manifest(spark, d):
    pages = t(spark, d, "pages").select("page_id", F.col("url").alias("path"), F.length("html").alias("length"))
    m = media.manifest(pages, "clips", run_ts=F.expr(RUN_NTZ), keep=["page_id"])
    return m.select(
        "page_id", "src_path", "dest_path", "content_type", "length",
        exprs.base_name("src_path").alias("base_name"), exprs.dir_name("src_path").alias("dir_name"))


#: Pages in one media object: an object is read as one row.
MEDIA_PAGES = 1_000
_URL_LANG = r"^[a-z]+://[^/]+/([^/]+)/"


@query("media_copy", """
SELECT page_id, CAST(length(html) AS BIGINT) AS n_chars, 'application/json' AS content_type FROM pages""")
def media_copy(spark, d):
    """Pages land as JSON objects, which are copied to their manifest places and from there to plain names; every page is read back.

    (Spark's local file system cannot read names with colons, which the manifest's times have; hence the second copy.)
    """
    root, dest, plain = (work_dir(spark, f"media-{x}") for x in ("src", "dest", "plain"))
    t(spark, d, "pages").select("page_id", "html").write.json(root)
    copied = media.copy_media(spark, root, dest, "clips", run_ts=F.expr(RUN_NTZ), glob="*.json")
    again = copied.where("copied = length").select(F.concat(F.lit(media.qualified(spark, dest) + "/"), "dest_path").alias("src_path"),
                                                   exprs.base_name("src_path").alias("dest_path"), "content_type", "length")
    whole = media.copy_objects(again, plain).where("copied = length").select(F.col("dest_path").alias("name"), "content_type")
    back = (spark.read.schema("page_id bigint, html string").json(plain)
            .select("page_id", F.length("html").cast("bigint").alias("n_chars"), F.col("_metadata.file_name").alias("name")))
    return back.join(whole, "name").select("page_id", "n_chars", "content_type")


@query("media_bytes", f"""
SELECT regexp_extract(url, '{_URL_LANG}', 1) AS lang,
       CAST(sum(strlen(html) - strlen(replace(html, chr(10), '')) + 1) AS BIGINT) AS n_lines,
       CAST(sum(strlen(html) + 1) AS BIGINT) AS length
FROM pages GROUP BY 1""")
def media_bytes(spark, d):
    """Pages land as media objects in a folder per language, at most ``MEDIA_PAGES`` in one; the bytes are read back and added up by language."""
    root = work_dir(spark, "media")
    pages = t(spark, d, "pages").select(F.regexp_extract("url", _URL_LANG, 1).alias("lang"), "html")
    pages.write.option("maxRecordsPerFile", MEDIA_PAGES).partitionBy("lang").text(root)
    files = media.read_media(spark, root, glob="*.txt").select(
        F.regexp_extract("path", r"lang=([^/]+)", 1).alias("lang"),
        (F.size(F.split(F.decode("content", "UTF-8"), "\n")) - 1).cast("bigint").alias("n_lines"),
        F.octet_length("content").cast("bigint").alias("length"))
    return files.groupBy("lang").agg(F.sum("n_lines").alias("n_lines"), F.sum("length").alias("length"))


# J8 export -----------------------------------------------------------------------------------
_ORDERS_CSV = T.StructType([
    T.StructField("O_ORDERKEY", T.LongType()), T.StructField("O_CUSTKEY", T.LongType()),
    T.StructField("O_ORDERSTATUS", T.StringType()), T.StructField("O_TOTALPRICE", T.DoubleType()),
    T.StructField("O_ORDERDATE", T.StringType()), T.StructField("O_ORDERPRIORITY", T.StringType()),
])


def _export_orders(spark, d, rows_per_part: int):
    out = work_dir(spark, "export")
    res = export.export_csv(t(spark, d, "orders"), out, "orders.csv", rows_per_part=rows_per_part,
                            order_by=["o_orderkey"])
    back = export.read_csv(spark, out + "/*.csv", _ORDERS_CSV).withColumn("file_name", F.col("_metadata.file_name"))
    return back, res


@query("csv_export_parts", """
WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 + 1 AS part FROM orders)
SELECT CAST(part AS BIGINT) AS part, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM r GROUP BY part""")
def csv_export_parts(spark, d):
    back, _ = _export_orders(spark, d, 4000)
    part = F.regexp_extract("file_name", r"-part(\d+)\.csv$", 1)
    return back.groupBy(F.when(part == "", "1").otherwise(part).cast("bigint").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("O_ORDERKEY").alias("first_key"), F.max("O_ORDERKEY").alias("last_key"))


@query("csv_file_names", """
WITH r AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 6000 + 1 AS part FROM orders)
SELECT CASE WHEN (SELECT count(*) FROM orders) <= 6000 THEN 'orders.csv'
            ELSE 'orders-part' || CAST(part AS VARCHAR) || '.csv' END AS file_name, count(*) AS n_rows
FROM r GROUP BY part""")
def csv_file_names(spark, d):
    back, _ = _export_orders(spark, d, 6000)
    return back.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))


@query("csv_roundtrip", """
SELECT o_orderkey AS O_ORDERKEY, o_custkey AS O_CUSTKEY, o_orderstatus AS O_ORDERSTATUS,
       o_totalprice AS O_TOTALPRICE, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS O_ORDERDATE,
       o_orderpriority AS O_ORDERPRIORITY FROM orders""")
def csv_roundtrip(spark, d):
    back, _ = _export_orders(spark, d, 500_000)
    return back.drop("file_name")


@query("csv_export_any_names", """
SELECT o_orderkey AS a, o_custkey AS b, o_orderstatus AS s1, o_orderpriority AS s2, nullif(o_orderstatus, 'F') AS note FROM orders""")
def csv_export_any_names(spark, d):
    """SQL text to CSV with columns named as the numbering's own, a repeated name and nulls; read back by position."""
    register_tables(spark, d, ["orders"])
    out = work_dir(spark, "export-names")
    export_query(spark, "SELECT o_orderkey AS part, o_custkey AS _rn, o_orderstatus AS s, o_orderpriority AS s, "
                        "nullif(o_orderstatus, 'F') AS note FROM orders WHERE o_orderkey >= :low", out, "names.csv", args={"low": 0},
                 rows_per_part=4000, order_by=["part"], case="lower")
    return export.read_csv(spark, out + "/*.csv", T._parse_datatype_string("a bigint, b bigint, s1 string, s2 string, note string"))


_ONE_COLUMN = "CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END"


@query("csv_export_one_column", f"""
SELECT coalesce({_ONE_COLUMN}, '') AS v, count(*) AS n_rows FROM orders GROUP BY 1""")
def csv_export_one_column(spark, d):
    """A one-column result keeps its null and empty rows."""
    register_tables(spark, d, ["orders"])
    out = work_dir(spark, "export-one")
    export_query(spark, f"SELECT {_ONE_COLUMN} AS v FROM orders", out, "one.csv", rows_per_part=5000)
    back = export.read_csv(spark, out + "/*.csv", T._parse_datatype_string("v string"))
    return back.groupBy(F.coalesce("v", F.lit("")).alias("v")).agg(F.count(F.lit(1)).alias("n_rows"))


# J9 gate, J11 publish, scalar functions ---------------------------------------------------------
@query("sql_gate_cell", """
SELECT count(*) AS cell, count(*) <> 0 AS passed FROM orders WHERE o_orderstatus = 'F'""")
def sql_gate_cell(spark, d):
    register_tables(spark, d, ["orders"])
    return gate.gate_frame(spark, "SELECT count(*) AS n FROM orders WHERE o_orderstatus = :status",
                           args={"status": "F"})


# (case, first cell as SQL text, rows kept, expected truth of the gate in SQL)
_GATE_CASES = [
    ("count", "count(*)", "o_orderstatus = 'F'", "count(*) FILTER (o_orderstatus = 'F') <> 0"),
    ("zero", "count(*)", "o_orderkey < 0", "count(*) FILTER (o_orderkey < 0) <> 0"),
    ("fraction", "sum(o_totalprice) / 1e12", "true", "sum(o_totalprice) <> 0"),
    ("text_zero", "concat('0', left(min(o_orderstatus), 0))", "true", "count(*) > 0"),
    ("text_empty", "left(min(o_orderstatus), 0)", "true", "count(*) < 0"),
    ("null", "max(o_orderkey)", "o_orderkey < 0", "max(o_orderkey) FILTER (o_orderkey < 0) IS NOT NULL"),
    ("boolean", "max(o_totalprice) > 0", "true", "max(o_totalprice) > 0"),
    ("interval_zero", "max(o_orderdate) - max(o_orderdate)", "true", "count(*) < 0"),
    ("interval", "max(o_orderdate) - min(o_orderdate)", "true", "max(o_orderdate) <> min(o_orderdate)"),
]


@query("sql_gate_truth", " UNION ALL ".join(
    [f"SELECT '{name}' AS gate, CASE WHEN {want} THEN 'pass' ELSE 'stop' END AS by_cell, "
     f"CASE WHEN {want} THEN 'pass' ELSE 'stop' END AS by_frame FROM orders" for name, _, _, want in _GATE_CASES]
    + ["SELECT 'no_row', 'stop', 'stop' FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
       "SELECT 'no_row_fails', 'error', 'stop' FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
       "SELECT 'failure', 'error', 'pass' FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
       "SELECT 'success', 'stop', 'pass' FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)",
       "SELECT 'failure_before_success', 'error', 'pass' FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)"]))
def sql_gate_truth(spark, d):
    """The gate's decisions over queries on ``orders``: by the driver's gate and by the one-row frame."""
    register_tables(spark, d, ["orders"])
    most = "SELECT max(o_orderkey) FROM orders"
    cases = [(name, f"SELECT {cell} FROM orders WHERE {where}", {}) for name, cell, where, _ in _GATE_CASES]
    cases += [("no_row", "SELECT o_orderkey FROM orders WHERE o_orderkey < 0", {}),
              ("no_row_fails", "SELECT o_orderkey FROM orders WHERE o_orderkey < 0", {"fail_on_empty": True}),
              ("failure", most, {"failure": lambda v: v > 0}), ("success", most, {"success": lambda v: v < 0}),
              ("failure_before_success", most, {"failure": lambda v: v > 0, "success": lambda v: v > 0})]
    rows = []
    for name, sql, options in cases:
        try:
            cell = "pass" if gate.sql_gate(spark, sql, **options) else "stop"
        except gate.GateError:
            cell = "error"
        frame = gate.gate_frame(spark, sql).first()
        rows.append((name, cell, "pass" if frame and frame.passed else "stop"))
    return spark.createDataFrame(rows, "gate string, by_cell string, by_frame string")


@query("publish_requests", """
SELECT event_id, event_type AS title, 'private' AS privacy,
       strftime(ts + INTERVAL 10 DAY, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS published_at,
       'false' AS notify, event_type AS first_tag FROM events""")
def publish_requests(spark, d):
    ev = t(spark, d, "events")
    queue = ev.select("event_id", "ts", F.col("event_type").alias("title"), F.col("props").alias("description"),
                      F.lit(22).alias("categoryId"), F.array("event_type").alias("tags"))
    req = publish.publish_requests(queue, now=F.col("ts"), keep=["event_id"])
    j = F.col("request")
    return req.select(
        "event_id",
        F.get_json_object(j, "$.snippet.title").alias("title"),
        F.get_json_object(j, "$.status.privacyStatus").alias("privacy"),
        F.get_json_object(j, "$.status.publishedAt").alias("published_at"),
        F.get_json_object(j, "$.notifySubscribers").alias("notify"),
        F.get_json_object(j, "$.snippet.tags[0]").alias("first_tag"),
    )


@query("array_index_safe", f"""
SELECT page_id, regexp_extract_all(html, '{HREF}', 1)[2] AS second_href FROM pages""")
def array_index_safe(spark, d):
    pages = t(spark, d, "pages")
    return pages.select("page_id", exprs.nth(F.regexp_extract_all("html", F.lit(HREF), 1), 1).alias("second_href"))


# SQL-1: query text over registered views ------------------------------------------------------
SQL_TEXT = {
    "sql_join_agg": """
SELECT n.n_name AS nation, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name""",
    "sql_cube": """
SELECT o_orderstatus, o_orderpriority, count(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
    "sql_window": """
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS rn,
       count(*) OVER (PARTITION BY o_custkey) AS cust_orders
FROM orders""",
    "sql_setops": """
(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
 INTERSECT SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')
UNION
(SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders)""",
    "sql_topk": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
}


def _sql_query(text: str) -> Query:
    def run(spark, d):
        register_tables(spark, d, ["orders", "customer", "nation"])
        return spark.sql(text)
    return run


for _name, _text in SQL_TEXT.items():
    query(_name, _text)(_sql_query(_text))


from . import table_queries  # noqa: E402, F401  (registers more)


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: J1 on stand-in documents, then images per video (count, max width)."""
    ent = _entities(spark, sf_dir)
    return ent.thumbnail.groupBy("VideoID").agg(F.count(F.lit(1)).alias("n_images"),
                                                F.max("Width").alias("max_width"))
