"""Listings of many folders, frequent values beyond a sketch's size, media and raw documents in bounded files."""

import gzip
import os

from pyspark.sql import functions as F

from reelhouse.operators import sketches
from reelhouse.plans import queries, standins
from reelhouse.session import work_dir
from reelhouse.sources import objects


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_a_level_of_many_folders_has_a_bounded_number_of_tasks(spark, monkeypatch):
    root, listings = work_dir(spark, "many-folders"), []
    rows = spark.range(200).select(F.format_string("d%d/x/part-%d.txt", "id", "id").alias("name"), F.lit("a\n").alias("content"))
    assert objects.put_objects(rows, root) == 200
    assert objects.put_objects(rows, root) == 200                   # written again: the same names
    monkeypatch.setattr(objects, "FOLDERS_PER_TASK", 1)
    monkeypatch.setattr(objects, "work_dir", lambda s, name: listings.append(work_dir(s, name)) or listings[-1])
    found = objects.list_tree(spark, root, "part-*.txt")
    assert found.where("length = 2").select("path").distinct().count() == found.count() == 200
    most = objects.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert max(len([f for f in os.listdir(local(p)) if f.endswith(".parquet")]) for p in listings) <= most


def test_frequent_values_of_many_equally_frequent_ones(spark):
    n = 8 * sketches.FREQUENT
    once = spark.range(n).select(F.lit("2024-01-01").cast("date").alias("day"), F.when(F.col("id") % 2 == 0, "a").alias("entity"), F.col("id").alias("user"), F.lit(1.0).alias("number"))
    few = spark.sql("SELECT DATE '2024-01-02' AS day, 'few' AS entity, explode(array(5L, 5L, 6L, null)) AS user, 1D AS number")
    rows = once.unionByName(once.where("id IN (10, 12, 13)")).unionByName(once.where("id = 12")).unionByName(few)
    table, columns = work_dir(spark, "sketches-many"), {"day": "day", "entity": "entity", "distinct": "user", "number": "number", "value": "user"}
    for load in ("a", "a"):                                         # a retried load replaces its own
        sketches.add_load(rows, table, load, **columns)
    got = {r.entity: [(x["item"], x["count"]) for x in r.top] for r in
           sketches.answers(sketches.read_table(spark, table), "entity", top=2, values=sketches.read_values(spark, table)).collect()}
    assert got["a"] == [(12, 3), (10, 2)] and got[None] == [(13, 2), (1, 1)]
    assert got["few"][0] == (5, 2)
    whole = sketches.answers(sketches.read_table(spark, table), top=1, values=sketches.read_values(spark, table)).collect()
    assert [(r.n_rows, r.top[0]["item"], r.top[0]["count"]) for r in whole] == [(n + 8, 5, 3)]      # as often as 12, and smaller


def test_media_of_one_language_lie_in_bounded_objects(spark, monkeypatch, tmp_dir):
    spark.range(95).select(F.col("id").alias("page_id"), F.lit("https://a.b/de/x").alias("url"), F.lit("one\ntwo").alias("html")).write.parquet(tmp_dir + "/pages.parquet")
    sizes, read = [], queries.media.read_media
    monkeypatch.setattr(queries, "MEDIA_PAGES", 10)
    monkeypatch.setattr(queries.media, "read_media", lambda *a, **k: sizes.append(read(*a, **k)) or sizes[-1])
    assert [tuple(r) for r in queries.media_bytes(spark, tmp_dir).collect()] == [("de", 190, 760)]
    assert sizes[0].agg(F.max("length")).first()[0] <= 80


def test_raw_documents_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(standins, "RAW_DOCUMENTS", 10, raising=False)
    docs = spark.range(0, 95, 1, 2).select(F.concat(F.lit('{"n": '), "id", F.lit("}")).alias("value"))
    path = local(standins.land_documents(docs, "bounded"))
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    assert all(f.endswith(".gz") for f in files) and all(len(gzip.open(f).read().splitlines()) <= 10 for f in files)
    assert sorted(r.n for r in spark.read.json(path).collect()) == list(range(95))
