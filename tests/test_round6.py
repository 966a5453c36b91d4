"""Line checks that parse no plain line, reports that sort no line, merges that check a day once."""

from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import entities
from reelhouse.sinks import landing, warehouse

LINES = [
    '{"_record":"x","VideoID":null,"ChannelID":"a","Length":5,"Views":12,"Timestamp":1.5}', '{"VideoID":"a\\nb"}', '{"VideoID":"a\\u00e9"}', '{}',
    '{"Length":5}', '{"Length":-0}', '{"Length":null}', '{"Timestamp":1.7040672E9}', '{"Title":"' + "y" * 20000 + '"}',          # plain
    '{"VideoID":"a\\","ChannelID":"b"}', '{"VideoID":"a\\\\","ChannelID":"b"}', '{"VideoID":"a\\q"}', '{"VideoID":"\\u12"}', '{"VideoID":"\\ud83d\\ude00"}',
    '{"VideoID":"\\ud83d"}', '{"VideoID":"a",}', '{"VideoID":"a","VideoID":"b"}', '{"VideoID":"a" }', '{"VideoID":"é"}', '{"VideoID":"say \\"x\\""}',
    '{"Title":"a\tb"}', '{"Title":"a"}x', '{"ChannelID: STRING, Length":5}', '{"Views":1,"Zed":1}', '{"Zed":1}', '{"length":1}', '{"Length":05}', '{"Length":5.0}',
    '{"Length":5.5}', '{"Length":"5"}', '{"Length":true}', '{"Length":99999999999999999999}', '{"Title":[1]}', '{"Title":{}}', '{"Title":1.25}',
    '{"Timestamp":1e400}', '{"Timestamp":"1"}', '{"Timestamp":1.E9}', '{"_record":{"a":1}}', "[]", "x", "null", None,
]


def test_plain_lines_are_judged_like_all_others(spark, monkeypatch):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    plain = warehouse._plain_line(F.col("value"), schemas.VIDEO, warehouse.LANDING_FIELDS)
    assert [bool(r.p) for r in lines.select(plain.alias("p")).collect()] == [i < 9 for i in range(len(LINES))]
    assert warehouse._plain_line(F.col("value"), schemas.CAPTION, warehouse.LANDING_FIELDS) is None
    got = warehouse.line_checks(lines, schemas.VIDEO).select("value", "is_bad", "reason").collect()
    monkeypatch.setattr(warehouse, "_plain_line", lambda *args: None)
    assert got == warehouse.line_checks(lines, schemas.VIDEO).select("value", "is_bad", "reason").collect()


def test_reports_sort_no_line(spark):
    lines = spark.createDataFrame([(f"f{i % 3}", f"f{i % 3}", '{"VideoID":"a"}' if i % 3 else x) for i, x in enumerate(LINES)], "file_path string, file_name string, value string")
    report = warehouse.load_report(warehouse.line_checks(lines, schemas.VIDEO))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in [x for x in plan.splitlines() if "Aggregate" in x][-1]
    bad = [r.reason for r in warehouse.line_checks(lines, schemas.VIDEO).where("file_path = 'f0' AND is_bad").select("reason").collect()]
    assert [(r.file_path, r.n_rows, r.n_bad, r.status) for r in report.orderBy("file_path").collect()] == [
        ("f0", 15, len(bad), "failed"), ("f1", 14, 0, "loaded"), ("f2", 14, 0, "loaded")]
    assert report.where("n_bad > 0").first().reason == min(bad, key=lambda r: tuple((x is not None, x or "") for x in r))


def test_a_merge_checks_the_day_once(spark, tmp_dir):
    rows = spark.range(6).select(F.concat("id", F.lit("_1")).alias(landing.RECORD), F.col("id").cast("string").alias("VideoID"), F.lit("old").alias("Title"))
    landing.land(rows, tmp_dir, "video", day="2024-1-1", merge=True)
    new = rows.where("VideoID < 2").withColumn("Title", F.lit("new"))
    merged, replaced = landing._merge_day(new, tmp_dir, "video", "2024-1-1")
    assert "Scan text" not in merged._jdf.queryExecution().executedPlan().toString() and replaced.count() > 0
    landing.land(new, tmp_dir, "video", day="2024-1-1", merge=True)
    lines, _ = warehouse.strict_load(spark, landing.entity_dir(tmp_dir, "video"), schemas.VIDEO, day="2024-1-1")
    assert sorted((r.VideoID, r.Title) for r in lines.collect()) == [(str(i), "new" if i < 2 else "old") for i in range(6)]


def test_unused_fields_still_decide_between_documents(spark):
    docs = spark.createDataFrame([(f"k{i % 4}", f"t{i}", [i]) for i in range(12)], "k string, t string, more array<int>")
    every = {r.k: r.t for r in entities.one_of_each(docs, "k").collect()}
    some = entities.one_of_each(docs, "k", ("more",))
    assert some.columns == ["k", "t"] and {r.k: r.t for r in some.collect()} == every and len(every) == 4
