"""Job entry points chained as a user runs them."""

import json
import os

from conftest import json_rows
from test_entities import channel, video

from reelhouse.plans import jobs
from reelhouse.sources import raw


def test_ingest_land_load_and_stream(spark, tmp_dir):
    tracks = [{"name": "English", "code": "en"}]
    caps = [{"code": "en", "json_captions": '{"e": [1]}'}]
    vids = raw.parse_videos(json_rows(spark, [video("a", tracks=tracks, captions=caps), video("b"),
                                              video("z", page=2)]))             # page 2 is not ingested
    chans = raw.parse_channels(json_rows(spark, [channel("ch1")]))
    landing_base, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    out = jobs.ingest_metadata(spark, vids, chans, landing_base, day="2023-6-4", run_ts=2.0)
    assert set(out) == {"video", "channel", "caption", "thumbnail"}
    report = jobs.load_warehouse(spark, landing_base, wh, day="2023-6-4")
    assert {r.status for r in report.collect()} == {"loaded"}
    counts = {n: spark.read.parquet(f"{wh}/{n}").count() for n in jobs.WIRE_SCHEMA}
    assert counts == {"video": 2, "channel": 2, "caption": 1, "thumbnail": 4}
    cap = spark.read.parquet(f"{wh}/caption").selectExpr("variant_get(Contents, '$.e[0]', 'int') AS e").first()
    assert cap.e == 1
    ck = os.path.join(tmp_dir, "ck")
    jobs.load_incremental(spark, landing_base, wh, ck, "video")
    assert spark.read.parquet(f"{wh}/video_stream").count() == 2
    jobs.load_incremental(spark, landing_base, wh, ck, "video")          # nothing new
    assert spark.read.parquet(f"{wh}/video_stream").count() == 2
    # a same-day re-run rewrites the day's files: kept records are not appended again
    more = raw.parse_videos(json_rows(spark, [video("b"), video("c")]))
    jobs.ingest_metadata(spark, more, chans, landing_base, day="2023-6-4", run_ts=3.0)
    jobs.load_incremental(spark, landing_base, wh, ck, "video")
    got = sorted(r.VideoID for r in spark.read.parquet(f"{wh}/video_stream").collect())
    assert got == ["a", "b", "c"]


def test_ingest_media(spark, tmp_dir):
    bucket, media_root, dest = (os.path.join(tmp_dir, x) for x in ("bucket", "media", "dest"))
    os.makedirs(os.path.join(bucket, "Video", "clips"))
    os.makedirs(media_root)
    with open(os.path.join(bucket, "Video", "clips", "old_v2.mp4"), "wb") as fh:
        fh.write(b"x")
    for v in ("v1", "v2", "v3"):
        with open(os.path.join(media_root, f"{v}.mp4"), "wb") as fh:
            fh.write(v.encode())
    videos = spark.createDataFrame(
        [("v1", False, [(22, True, "mp4")]), ("v2", False, [(22, True, "mp4")]), ("v3", True, [(22, True, "mp4")])],
        "video_id string, age_restricted boolean, streams array<struct<itag:int,progressive:boolean,file_extension:string>>")
    m = jobs.ingest_media(spark, videos, bucket, media_root, dest, run_ts=None)
    rows = m.collect()
    assert [os.path.basename(r.src_path) for r in rows] == ["v1.mp4"]
    with open(os.path.join(dest, rows[0].dest_path), "rb") as fh:
        assert fh.read() == b"v1"


def test_category_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cats.json")
    with open(path, "w") as fh:
        fh.write(json.dumps({"kind": "list", "items": [{"id": "1", "snippet": {"title": "Film", "assignable": True}}]}))
    assert [(r.id, r.title) for r in jobs.category_table(spark, path).collect()] == [("1", "Film")]


def test_checkpoint_staging_same_rows(spark, tmp_dir):
    vids = raw.parse_videos(json_rows(spark, [video("a"), video("b")]))
    chans = raw.parse_channels(json_rows(spark, [channel("ch1")]))
    a = jobs.ingest_metadata(spark, vids, chans, os.path.join(tmp_dir, "p"), day="2023-6-4", run_ts=1.0)
    b = jobs.ingest_metadata(spark, vids, chans, os.path.join(tmp_dir, "c"), day="2023-6-4", run_ts=1.0,
                             stage="checkpoint")
    for name in a:
        ra = sorted(r.value for r in spark.read.text(a[name]).collect())
        rb = sorted(r.value for r in spark.read.text(b[name]).collect())
        assert ra == rb, name
    assert len(sorted(r.value for r in spark.read.text(b["thumbnail"]).collect())) == 4


def test_same_day_rerun_replaces_only_relanded_records(spark, tmp_dir):
    chans = raw.parse_channels(json_rows(spark, [channel("ch1")]))
    base, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    run1 = raw.parse_videos(json_rows(spark, [video("a"), video("b", title="old")]))
    run2 = raw.parse_videos(json_rows(spark, [video("b", title="new"), video("c")]))
    jobs.ingest_metadata(spark, run1, chans, base, day="2023-6-4", run_ts=1.0)
    jobs.ingest_metadata(spark, run2, chans, base, day="2023-6-4", run_ts=2.0)
    jobs.load_warehouse(spark, base, wh, day="2023-6-4")
    got = {r.VideoID: (r.Title, r.Timestamp) for r in spark.read.parquet(f"{wh}/video").collect()}
    assert got == {"a": ("t-a", 1.0), "b": ("new", 2.0), "c": ("t-c", 2.0)}
    thumbs = sorted(r.ThumbnailID for r in spark.read.parquet(f"{wh}/thumbnail").collect())
    assert thumbs == ["a_1", "a_2", "b_1", "b_2", "c_1", "c_2"]
    assert spark.read.parquet(f"{wh}/channel").count() == 3


def test_video_listed_twice_lands_once(spark, tmp_dir):
    import datetime as dt
    chans = raw.parse_channels(json_rows(spark, [channel("ch1")]))
    vids = raw.parse_videos(json_rows(spark, [video("a"), video("a"), video("b")]))
    base, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    jobs.ingest_metadata(spark, vids, chans, base, day=dt.date(2023, 6, 4), run_ts=1.0)
    jobs.load_warehouse(spark, base, wh, day=dt.date(2023, 6, 4))
    assert sorted(r.VideoID for r in spark.read.parquet(f"{wh}/video").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{wh}/thumbnail").count() == 4


def test_ingest_survives_a_failed_task(spark, tmp_dir):
    """A task of the staged ingest fails once (as on a lost executor); the landing is complete."""
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    @F.udf("string")
    def flaky(x):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        return x

    docs = raw.parse_videos(json_rows(spark, [video(f"v{i}") for i in range(12)])).repartition(3)
    docs = docs.withColumn("title", flaky("title"))
    chans = raw.parse_channels(json_rows(spark, [channel("ch1")]))
    base, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    jobs.ingest_metadata(spark, docs, chans, base, day="2023-6-4", run_ts=1.0)
    jobs.load_warehouse(spark, base, wh, day="2023-6-4")
    assert spark.read.parquet(f"{wh}/video").count() == 12
    assert spark.read.parquet(f"{wh}/thumbnail").count() == 24
