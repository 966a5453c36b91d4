"""J4: file-source stream with availableNow; second run adds nothing; keyed de-dup."""

import os

from reelhouse.streaming import incremental


def test_second_run_adds_nothing_then_new_file(spark, tmp_dir):
    schema = "VideoID string, Views bigint"
    src, table, ck = (os.path.join(tmp_dir, x) for x in ("src", "table", "ck"))
    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.json(src)
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    assert incremental.load_new_files(spark, src, st, table, ck) == 2
    assert incremental.load_new_files(spark, src, st, table, ck) == 0
    assert spark.read.parquet(table).count() == 2
    spark.createDataFrame([("c", 3)], schema).write.mode("append").json(src)
    incremental.load_new_files(spark, src, st, table, ck)
    assert sorted(r.VideoID for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def test_skip_already_stored_keys(spark, tmp_dir):
    schema = "VideoID string, Views bigint"
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    src, table, ck = (os.path.join(tmp_dir, x) for x in ("src", "table", "ck"))
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], schema).write.json(src)
    incremental.load_new_files(spark, src, st, table, ck, dedup_keys=["VideoID"])
    spark.createDataFrame([("a", 9), ("c", 1)], schema).write.mode("append").json(src)
    incremental.load_new_files(spark, src, st, table, ck, dedup_keys=["VideoID"])
    assert sorted(r.VideoID for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def test_skip_already_stored_against_target(spark, tmp_dir):
    schema = "VideoID string, Views bigint"
    from pyspark.sql import types as T
    st = T._parse_datatype_string(schema)
    src, table, ck = (os.path.join(tmp_dir, x) for x in ("src", "table", "ck"))
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], schema).write.json(src)
    incremental.load_new_files(spark, src, st, table, ck, dedup_keys=["VideoID"], dedup_mode="target")
    spark.createDataFrame([("a", 9), ("c", 1)], schema).write.mode("append").json(src)
    incremental.load_new_files(spark, src, st, table, ck, dedup_keys=["VideoID"], dedup_mode="target")
    assert sorted(r.VideoID for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def _records(spark, rows, path, day):
    import json
    folder = os.path.join(path, f"ingest_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"f{len(os.listdir(folder))}.json"), "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def test_strict_load_late_days_null_records_and_bad_files(spark, tmp_dir):
    from pyspark.sql import types as T
    st = T._parse_datatype_string("VideoID string, Views bigint")
    src, table, ck = (os.path.join(tmp_dir, x) for x in ("src", "table", "ck"))

    def load():
        return incremental.load_new_records(spark, src, st, table, ck)

    _records(spark, [{"VideoID": "v10", "Views": 1, "_record": "v10_0"}], src, "2024-1-10")
    assert load() == 1
    _records(spark, [{"VideoID": "v11", "Views": 1, "_record": "v11_0"}], src, "2024-1-11")
    assert load() == 1
    _records(spark, [{"VideoID": "v2", "Views": 1, "_record": "v2_0"}], src, "2024-1-2")       # a day before both
    _records(spark, [{"VideoID": "n", "Views": i} for i in range(5)], src, "2024-1-2")          # no identity: all kept
    assert load() == 6
    _records(spark, [{"VideoID": "v2", "Views": 7, "_record": "v2_0"}, {"VideoID": "v3", "Views": 7, "_record": "v3_0"}], src, "2024-1-2")
    assert load() == 1                                                                          # v2 is stored
    _records(spark, [{"VideoID": "ok", "Views": 1, "_record": "ok"}, "{broken"], src, "2024-1-3")
    _records(spark, [{"VideoID": "x", "Views": 1.5}], src, "2024-1-3")
    _records(spark, [{"VideoID": "x", "Views": True}], src, "2024-1-3")
    _records(spark, [{"VideoID": "x", "other": 1}], src, "2024-1-3")
    assert load() == 0 and load() == 0
    rows = spark.read.parquet(table).collect()
    assert sorted(r.VideoID for r in rows) == ["n"] * 5 + ["v10", "v11", "v2", "v3"]
    assert {r.VideoID: r.Views for r in rows if r.VideoID == "v2"} == {"v2": 1}
    report = spark.read.parquet(table + "_load_report")
    assert report.where("status = 'failed'").count() == 4 and report.where("status = 'loaded'").count() == 5


def test_a_retried_batch_replaces_its_own_rows(spark, tmp_dir):
    from pyspark.sql import types as T
    import shutil
    st = T._parse_datatype_string("VideoID string, Views bigint")
    src, table, ck = (os.path.join(tmp_dir, x) for x in ("src", "table", "ck"))
    _records(spark, [{"VideoID": "a", "_record": "a"}, {"VideoID": "n"}], src, "2024-1-1")
    assert incremental.load_new_records(spark, src, st, table, ck) == 2
    shutil.rmtree(os.path.join(ck, "commits"))             # written, but the driver was lost before the commit
    assert incremental.load_new_records(spark, src, st, table, ck) == 2
    assert spark.read.parquet(table).count() == 2
