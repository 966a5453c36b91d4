"""J5 / J6: eligibility conditions and both anti-join plans."""

from pyspark.sql import functions as F

from reelhouse.operators import eligibility


def candidates(spark, rows):
    return spark.createDataFrame(
        rows, "video_id string, age_restricted boolean, "
              "streams array<struct<itag:int, progressive:boolean, file_extension:string>>")


GOOD = [(22, True, "mp4")]


def test_each_condition_alone(spark):
    cand = candidates(spark, [
        ("ok1", False, GOOD),
        ("restr", True, GOOD),
        ("stored", False, GOOD),
        ("nostream", False, [(18, True, "mp4")]),
        ("nullstreams", False, None),
        ("notprog", False, [(22, False, "mp4")]),
        ("webm", False, [(22, True, "webm")]),
    ])
    names = spark.createDataFrame([("Video/clips/2024-01-01/x_stored.mp4",)], "path string")
    out = {r.video_id: r for r in eligibility.classify(cand, names).collect()}
    assert out["ok1"].eligible and out["ok1"].reject_reason is None
    assert out["restr"].reject_reason == "age_restricted"
    assert out["stored"].reject_reason == "already_stored"
    for k in ("nostream", "nullstreams", "notprog", "webm"):
        assert out[k].reject_reason == "no_itag_22", k
    accepted = {r.video_id for r in eligibility.eligible(cand, names).collect()}
    assert accepted == {"ok1"}


def test_substring_rules_and_scope(spark):
    cand = candidates(spark, [("abc", False, GOOD), ("ab", False, GOOD), ("zz", False, GOOD), ("meta", False, GOOD)])
    listing = spark.createDataFrame([("Video/yt/d/t_abc.mp4",), ("Metadata/Video/d/d_metadata_Video_meta_1.json",)],
                                    "path string")
    # 'ab' is a prefix of 'abc': a substring hit, kept on purpose
    all_scope = {r.video_id for r in eligibility.not_stored(cand, listing).collect()}
    assert all_scope == {"zz"}
    video_only = eligibility.in_scope(listing, scope="Video/")
    assert {r.video_id for r in eligibility.not_stored(cand, video_only).collect()} == {"zz", "meta"}


def test_substring_join_against_all_pairs(spark):
    keys = spark.range(0, 300).select(F.concat(F.lit("/k/"), F.col("id").cast("string")).alias("video_id"))
    names = spark.range(0, 300, 7).select(F.concat(F.lit("http://h/k/"), F.col("id").cast("string"), F.lit("?x")).alias("path"))
    got = eligibility.not_stored(keys, names)
    paths = [r.path for r in names.collect()]
    want = sorted(r.video_id for r in keys.collect() if not any(r.video_id in p for p in paths))
    assert sorted(r.video_id for r in got.collect()) == want
    assert "NestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_null_key_is_kept(spark):
    cand = spark.createDataFrame([(None,), ("x",)], "video_id string")
    names = spark.createDataFrame([("x",)], "path string")
    assert [r.video_id for r in eligibility.not_stored(cand, names).collect()] == [None]


def test_any_all_flags(spark):
    df = spark.createDataFrame([(1, True), (1, False), (2, True)], "g int, b boolean")
    out = {r.g: (r.any_flag, r.all_flag) for r in eligibility.any_all_flags(df, "g", F.col("b"), F.col("b")).collect()}
    assert out == {1: (True, False), 2: (True, True)}
