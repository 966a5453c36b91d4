"""J2 landing + J3 strict load: day partitions, per-file report, append semantics."""

import datetime as dt
import os

import pytest

from reelhouse import schemas
from reelhouse.sinks import landing, warehouse
from reelhouse.sources import landed


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


GOOD = '{"VideoID":"a","ChannelID":"c","Length":3,"Publish_date":"2023/6/4","Title":"t","Views":7,"Description":null,"Timestamp":1.5}'


def test_strict_rules_per_file(spark, tmp_dir):
    day = os.path.join(tmp_dir, "ingest_date=2023-6-4")
    cases = {
        "good.json": [GOOD, '{"VideoID":"b"}'],                                 # two lines, missing fields ok
        "quoted.json": ['{"VideoID":"q","Length":"12"}'],                       # quoted integer coerced
        "extra.json": [GOOD, '{"VideoID":"x","Bogus":1}'],                      # unknown field
        "array.json": ['{"VideoID":["x"]}'],                                    # array into STRING
        "float.json": ['{"VideoID":"f","Length":1.5}'],                         # fraction into BIGINT
        "broken.json": ['{"VideoID":"m"'],                                      # malformed
        "case.json": ['{"videoid":"lower"}'],                                   # name differs in case only
    }
    for name, lines in cases.items():
        write_lines(day, name, lines)
    write_lines(day, "notes.txt", ["not json"])                                 # not a .json file
    rows, report = warehouse.strict_load(spark, tmp_dir, schemas.VIDEO, day="2023-6-4")
    status = {r.file_name: (r.status, r.n_rows, r.n_bad) for r in report.collect()}
    assert status == {
        "good.json": ("loaded", 2, 0), "quoted.json": ("loaded", 1, 0), "extra.json": ("failed", 2, 1),
        "array.json": ("failed", 1, 1), "float.json": ("failed", 1, 1), "broken.json": ("failed", 1, 1),
        "case.json": ("failed", 1, 1),
    }
    got = {r.VideoID: r for r in rows.collect()}
    assert set(got) == {"a", "b", "q"}
    assert got["q"].Length == 12 and got["a"].Timestamp == 1.5 and got["b"].Length is None
    assert rows.schema == schemas.VIDEO


def test_fail_fast_raises(spark, tmp_dir):
    write_lines(os.path.join(tmp_dir, "ingest_date=2023-6-4"), "bad.json", ['{"Nope":1}'])
    with pytest.raises(warehouse.LoadError):
        warehouse.strict_load(spark, tmp_dir, schemas.VIDEO, day="2023-6-4", fail_fast=True)


def test_append_twice_doubles(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    table = os.path.join(tmp_dir, "t")
    warehouse.append(df, table)
    warehouse.append(df, table)
    assert spark.read.parquet(table).count() == 2


def test_landing_days_unpadded_and_overwrite(spark, tmp_dir):
    rows = [("a", dt.datetime(2023, 6, 1, 1)), ("b", dt.datetime(2023, 6, 14, 2)), ("c", dt.datetime(2023, 6, 14, 3))]
    df = spark.createDataFrame(rows, "VideoID string, ts timestamp_ntz")
    path = landing.land(df, tmp_dir, "video", ts_col="ts")
    landing.land(df.where("VideoID = 'b'"), tmp_dir, "video", ts_col="ts")    # re-land 2023-6-14 only
    schema = df.schema
    assert sorted(r.VideoID for r in landed.read_day(spark, path, schema, "2023-6-1").collect()) == ["a"]
    assert sorted(r.VideoID for r in landed.read_day(spark, path, schema, "2023-6-14").collect()) == ["b"]
    assert landed.read_day(spark, path, schema, "2023-06-01").count() == 1   # padded text is the same day
    for bad in ("2023-6", "2023/6/1", "2023-06-0x"):
        with pytest.raises(ValueError):
            landed.read_day(spark, path, schema, bad)
    assert os.path.isdir(os.path.join(path, "ingest_date=2023-6-1"))


def test_day_read_is_partition_pruned(spark, tmp_dir):
    df = spark.createDataFrame([("a", dt.datetime(2023, 6, 1))], "VideoID string, ts timestamp_ntz")
    path = landing.land(df, tmp_dir, "video", ts_col="ts")
    plan = landed.read_day(spark, path, df.schema, "2023-6-1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_landing_path_and_legacy(spark, tmp_dir):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("v1", "2023-6-4")], "k string, d string")
    p = df.select(landing.landing_path("caption", F.col("d"), F.col("k"), F.lit(2)).alias("p")).first().p
    assert p == "Metadata/Caption/2023-6-4/2023-6-4_metadata_Caption_v1_2.json"
    cap = spark.createDataFrame([("v1_1", "v1", "en", "{}", 1.0)], schemas.CAPTION_WIRE)
    target = landing.land_legacy(cap, tmp_dir, "caption")
    back = spark.read.json(target)
    assert "Timestamp" not in back.columns and "Caption_id" in back.columns


def test_files_per_day_bound(spark, tmp_dir):
    rows = [(f"v{i}", dt.datetime(2023, 6, 1 + i % 2, 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "VideoID string, ts timestamp_ntz").repartition(16)
    path = landing.land(df, tmp_dir, "video", ts_col="ts", files_per_day=3)
    for day in ("2023-6-1", "2023-6-2"):
        files = [f for f in os.listdir(os.path.join(path, f"ingest_date={day}")) if f.endswith(".json")]
        assert 1 <= len(files) <= 3
    assert landed.read_day(spark, path, df.schema).count() == 200
