"""Scalar expressions against their Python reference behaviour."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import exprs
from reelhouse.functions.lookups import CONTENT_TYPE, lookup

PATHS = ["a/b/c.mp4", "/a", "a", "", "a//b", "//a", "/", "http://h.com/x/y?z=1", "dir/", "a/b//"]


def test_base_and_dir_name_match_os_path(spark):
    df = spark.createDataFrame([(p,) for p in PATHS], "p string")
    got = df.select("p", exprs.base_name("p").alias("b"), exprs.dir_name("p").alias("d")).collect()
    for r in got:
        assert r.b == os.path.basename(r.p), r.p
        assert r.d == os.path.dirname(r.p), r.p


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 6, 4, 7, 8, 9),)], "ts timestamp_ntz")
    r = df.select(exprs.slash_date("ts").alias("a"), exprs.dash_date("ts").alias("b"),
                  exprs.padded_datetime("ts").alias("c"), exprs.iso_in_days("ts").alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("2023/6/4", "2023-6-4", "2023-06-04 07:08:09", "2023-06-14T07:08:09.000Z")


def test_parity_and_index(spark):
    df = spark.createDataFrame([(-3, dt.datetime(2024, 1, 1, 0, 2))], "n int, ts timestamp_ntz")
    r = df.select(exprs.is_odd("n").alias("o"), exprs.is_even_minute("ts").alias("e"),
                  exprs.nth(F.array(F.lit(1)), 1).alias("x")).first()
    assert r.o is True and r.e is True and r.x is None


def test_epoch_and_json(spark):
    r = spark.range(1).select(exprs.epoch_seconds(12.5).alias("t"),
                              exprs.to_json_keep_nulls(F.struct(F.lit(None).cast("string").alias("a"))).alias("j"),
                              F.variant_get(exprs.json_variant(F.lit('{"k": 3}')), "$.k", "int").alias("k"),
                              exprs.json_variant(F.lit("{broken")).isNull().alias("bad")).first()
    assert r.t == 12.5 and r.j == '{"a":null}' and r.k == 3 and r.bad is True
    now = spark.range(1).select(exprs.epoch_seconds().alias("t")).first().t
    assert now == pytest.approx(dt.datetime.now(dt.timezone.utc).timestamp(), abs=120)


def test_content_type_lookup(spark):
    df = spark.createDataFrame([("json",), ("mp4",), ("avi",)], "e string")
    got = [r.c for r in df.select(lookup(CONTENT_TYPE, F.col("e"), "other").alias("c")).collect()]
    assert got == ["application/json", "video/mp4", "other"]
