"""J1 entity extraction: the stage cascade and every edge row of the fixtures."""

from conftest import json_rows

from reelhouse.operators import entities
from reelhouse.sources import raw


def video(vid, channel="ch1", date="2023-06-04T00:00:00", thumbs=None, tracks=None, captions=None, title=None, **kw):
    d = {
        "search_term": "meme", "page": 1,
        "vid_info": {"videoDetails": {"videoId": vid, "thumbnail": {"thumbnails": thumbs if thumbs is not None else [
            {"url": f"u/{vid}/1", "width": 120, "height": 90}, {"url": f"u/{vid}/2", "width": 640, "height": 480}]}}},
        "channel_id": "CID-" + channel, "channel_url": "url/" + channel, "length": 10,
        "title": title or f"t-{vid}", "views": 5,
        "caption_tracks": tracks if tracks is not None else [],
        "captions": captions if captions is not None else [],
    }
    if date is not None:
        d["publish_date"] = date
    d.update(kw)
    return d


def item(vid, text="desc", runs=True):
    r = {"videoId": vid}
    if runs is True:
        r["descriptionSnippet"] = {"runs": [{"text": text}]}
    elif runs == "empty":
        r["descriptionSnippet"] = {"runs": []}
    return {"richItemRenderer": {"content": {"videoRenderer": r}}}


def channel(name, items=(), keywords="kw", tabs=2):
    meta = {"description": "about " + name}
    if keywords is not None:
        meta["keywords"] = keywords
    tab_list = [{"tabRenderer": {"title": "home"}}]
    if tabs >= 2:
        tab_list.append({"tabRenderer": {"content": {"richGridRenderer": {"contents": list(items)}}}})
    return {
        "channel_url": "url/" + name, "channel_id": "CID-" + name, "channel_name": name,
        "initial_data": {
            "metadata": {"channelMetadataRenderer": meta},
            "header": {"c4TabbedHeaderRenderer": {"subscriberCountText": {"simpleText": "1K"}}},
            "contents": {"twoColumnBrowseResultsRenderer": {"tabs": tab_list}},
        },
    }


def run(spark, videos, channels):
    v = raw.parse_videos(json_rows(spark, videos))
    c = raw.parse_channels(json_rows(spark, channels))
    return entities.extract_entities(v, c, run_ts=1.5)


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_video_fields_and_description_rules(spark):
    videos = [video("a", date="2023-06-04T10:00:00"), video("b"), video("c"), video("d")]
    chans = [channel("ch1", items=[item("b", "first"), item("x", "other"), item("b", "last"),
                                   item("c", "c1"), item("c", None)])]
    ent = run(spark, videos, chans)
    rows = by_key(ent.video, "VideoID")
    assert rows["a"]["Publish_date"] == "2023/6/4"      # month and day unpadded
    assert rows["a"]["Description"] is None              # no grid match
    assert rows["b"]["Description"] == "last"            # two matches: last wins
    assert rows["c"]["Description"] is None              # last match has null text
    assert rows["a"]["Timestamp"] == 1.5 and rows["a"]["Length"] == 10


def test_video_stage_failures(spark):
    videos = [video("ok"), video("norun"), video("nodate", date=None), video("onetab", channel="ch2")]
    chans = [channel("ch1", items=[item("norun", runs=False)]), channel("ch2", tabs=1)]
    ent = run(spark, videos, chans)
    assert set(by_key(ent.video, "VideoID")) == {"ok"}
    # a failed video stage stops every later entity of that video
    assert {r.VideoID for r in ent.thumbnail.collect()} == {"ok"}
    assert ent.channel.count() == 1


def test_empty_runs_list_fails_video(spark):
    ent = run(spark, [video("e")], [channel("ch1", items=[item("e", runs="empty")])])
    assert ent.video.count() == 0


def test_missing_channel_document_drops_everything(spark):
    ent = run(spark, [video("lost", channel="nowhere")], [channel("ch1")])
    assert all(df.count() == 0 for df in ent.tables().values())


def test_channel_rows_per_video_and_keywords_cascade(spark):
    videos = [video("a"), video("b"), video("k", channel="nokw")]
    ent = run(spark, videos, [channel("ch1"), channel("nokw", keywords=None)])
    assert ent.channel.count() == 2                       # two videos of one channel: two rows
    assert set(by_key(ent.video, "VideoID")) == {"a", "b", "k"}   # video kept
    assert "k" not in {r.VideoID for r in ent.thumbnail.collect()}
    assert "k" not in {r.VideoID for r in ent.caption.collect()}
    assert set(ent.channel.columns) >= {"Subcribed", "Keywords"}


def test_captions(spark):
    two = [{"name": "English", "code": "en"}, {"name": "French", "code": "fr"}]
    caps = [{"code": "en", "json_captions": '{"events": [1]}'}, {"code": "fr", "json_captions": '{"events": [2]}'}]
    videos = [
        video("none"),                                            # no tracks: 0 rows, thumbnails written
        video("two", tracks=two, captions=caps),
        video("miss", tracks=two, captions=caps[:1]),             # code without content
    ]
    ent = run(spark, videos, [channel("ch1")])
    caps_out = ent.caption.selectExpr("Contents_caption_id", "Language",
                                      "variant_get(Contents, '$.events[0]', 'int') AS e").collect()
    assert sorted((r.Contents_caption_id, r.Language, r.e) for r in caps_out) == [
        ("two_1", "English", 1), ("two_2", "French", 2)]
    thumbs = {r.VideoID for r in ent.thumbnail.collect()}
    assert thumbs == {"none", "two"}                              # 'miss' lost captions and thumbnails


def test_thumbnails(spark):
    videos = [
        video("empty", thumbs=[]),
        video("nowidth", thumbs=[{"url": "x", "width": 1, "height": 1}, {"url": "y", "height": 2}]),
        video("two"),
    ]
    ent = run(spark, videos, [channel("ch1")])
    rows = sorted((r.ThumbnailID, r.Width) for r in ent.thumbnail.collect())
    assert rows == [("two_1", 120), ("two_2", 640)]


def test_fanout_counts_match_tables(spark):
    videos = [video("a", tracks=[{"name": "E", "code": "en"}], captions=[{"code": "en", "json_captions": "{}"}]),
              video("b", channel="nokw")]
    ent = run(spark, videos, [channel("ch1"), channel("nokw", keywords=None)])
    c = entities.fanout_counts(ent.joined).first()
    assert (c.n_video, c.n_channel, c.n_caption, c.n_thumbnail) == (
        ent.video.count(), ent.channel.count(), ent.caption.count(), ent.thumbnail.count())


def test_fatal_missing_video_id(spark):
    import pytest
    v = raw.parse_videos(json_rows(spark, [video(None)]))
    with pytest.raises(Exception, match="videoId"):
        raw.with_video_id(v).select("video_id").collect()


def test_first_page_only(spark):
    feed = raw.parse_videos(json_rows(spark, [video("p1"), video("p2", page=2), video("other", search_term="cat")]))
    assert [r.videoId for r in raw.first_page(feed).select("vid_info.videoDetails.videoId").collect()] == ["p1"]


def test_plan_has_no_python_udf(spark):
    ent = run(spark, [video("a")], [channel("ch1")])
    for df in ent.tables().values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_hot_channel_salting_gives_same_rows(spark):
    from reelhouse.operators import skew
    videos = [video(f"h{i}") for i in range(40)] + [video("c1", channel="cold")]
    chans = [channel("ch1", items=[item("h3", "d3")]), channel("cold")]
    v = raw.parse_videos(json_rows(spark, videos))
    c = raw.parse_channels(json_rows(spark, chans))
    plain = entities.extract_entities(v, c, run_ts=1.0)
    salted = entities.extract_entities(v, c, run_ts=1.0, hot_share=0.3, hot_buckets=4)
    for name in ("video", "channel", "caption", "thumbnail"):
        a = sorted(map(tuple, plain.tables()[name].drop("Contents").collect()))
        b = sorted(map(tuple, salted.tables()[name].drop("Contents").collect()))
        assert a == b, name
    hot = [r.channel_url for r in skew.hot_keys(v, "channel_url", 0.3).collect()]
    assert hot == ["url/ch1"]


def test_nested_pruning_reaches_the_json_scan(spark, tmp_path):
    import json as _json
    vpath, cpath = str(tmp_path / "v"), str(tmp_path / "c")
    for path, docs in ((vpath, [video("a")]), (cpath, [channel("ch1")])):
        import os as _os
        _os.makedirs(path)
        with open(_os.path.join(path, "part.json"), "w") as fh:
            fh.write("\n".join(_json.dumps(d) for d in docs) + "\n")
    ent = entities.extract_entities(raw.read_raw_videos(spark, vpath), raw.read_raw_channels(spark, cpath), 1.0)
    plan = ent.video._jdf.queryExecution().executedPlan().toString()
    schemas_read = [line for line in plan.split("\n") if "ReadSchema" in line]
    assert schemas_read and not any("streams" in s or "captions" in s or "avatar" in s for s in schemas_read)


def test_salting_spreads_a_hot_channel_over_tasks(spark):
    from pyspark.sql import functions as F
    videos = [video(f"h{i}", channel="hot") for i in range(60)] + [video(f"c{i}", channel=f"c{i}") for i in range(20)]
    chans = [channel("hot")] + [channel(f"c{i}") for i in range(20)]
    v = raw.parse_videos(json_rows(spark, videos))
    c = raw.parse_channels(json_rows(spark, chans))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # force a shuffled join
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def tasks_for_hot(**kw):
            j = entities.join_documents(v, c, **kw).where("channel_url = 'url/hot'")
            return j.select(F.spark_partition_id().alias("p")).distinct().count()
        plain = tasks_for_hot()
        salted = tasks_for_hot(hot_share=0.3, hot_buckets=8)
    finally:
        for k, val in saved.items():
            spark.conf.set(k, val)
    assert salted > 1 and salted >= plain


def test_salted_join(spark):
    from reelhouse.operators import skew
    big = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    small = spark.createDataFrame([("k1", "a"), ("k2", "b")], "k string, w string")
    out = skew.salted_join(big, small, "k", big.select("k").limit(1), buckets=3)
    assert sorted((r.k, r.v, r.w) for r in out.collect()) == [("k1", 1, "a"), ("k2", 2, "b")]


def test_duplicate_documents_and_malformed_captions(spark):
    tracks = [{"name": "English", "code": "en"}]
    good, bad = [{"code": "en", "json_captions": '{"e": 1}'}], [{"code": "en", "json_captions": "{broken"}]
    vids = [video("a", tracks=tracks, captions=good), video("a", tracks=tracks, captions=good), video("b", tracks=tracks, captions=bad),
            video("c", tracks=tracks, captions=bad + good), video("d", tracks=tracks, captions=good + bad)]
    v, c = raw.parse_videos(json_rows(spark, vids)), raw.parse_channels(json_rows(spark, [channel("ch1"), channel("ch1")]))
    ent = entities.extract_entities(v, c, run_ts=1.0, distinct_videos=True)
    assert sorted(r.VideoID for r in ent.video.collect()) == ["a", "b", "c", "d"]
    assert sorted(r.VideoID for r in ent.caption.collect()) == ["a", "c"]      # the last caption of a code counts
    assert {r.VideoID for r in ent.thumbnail.collect()} <= {"a", "c"}
