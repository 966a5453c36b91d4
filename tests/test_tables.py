"""Listing, manifests, compaction, split reads, Bloom probing, refusal reasons."""

import datetime as dt
import os
import random
from urllib.parse import unquote

import duckdb
import pytest
from pyspark.sql import functions as F

from reelhouse.operators import bloom, eligibility
from reelhouse.plans import jobs, standins
from reelhouse.sinks import compaction, landing, manifest, media, warehouse
from reelhouse.sources import landed, objects, sql


# --- listing ---------------------------------------------------------------------------------

def test_listing_of_thousands_of_folders_and_one_large_one(spark, tmp_path):
    want = set()
    for i in range(2000):
        os.makedirs(tmp_path / f"d{i % 40}" / f"e{i}")
        (tmp_path / f"d{i % 40}" / f"e{i}" / "a b.mp4").write_text("x" * (i % 7))
        want.add((f"d{i % 40}/e{i}/a b.mp4", i % 7))
    os.makedirs(tmp_path / "all")
    for i in range(1000):
        (tmp_path / "all" / f"{i}.mp4").write_text("y")
        want.add((f"all/{i}.mp4", 1))
    for name in ("_hidden", ".secret"):
        os.makedirs(tmp_path / name)
        (tmp_path / name / "no.mp4").write_text("n")
    (tmp_path / "top.json").write_text("t")
    root = "file:" + str(tmp_path)
    found = objects.list_tree(spark, str(tmp_path))
    got = {(r.path, r.length) for r in found.collect()}
    assert got == {(f"{root}/{p}", n) for p, n in want} | {(root + "/top.json", 1)}
    assert {r.path for r in objects.list_tree(spark, str(tmp_path), "*.{json,txt}").collect()} == {root + "/top.json"}
    assert {r.path for r in media.list_objects(spark, str(tmp_path), "7?.mp4").collect()} == {f"{root}/all/7{k}.mp4" for k in range(10)}
    spark_names = {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path").collect()}
    assert {p for p, n in got if n} == {unquote(unquote(p)) for p in spark_names}         # a scan makes no split of an empty object


def test_listing_of_nothing_and_removal(spark, tmp_path):
    os.makedirs(tmp_path / "a" / "b")
    assert objects.list_tree(spark, str(tmp_path)).count() == 0
    assert objects.list_tree(spark, str(tmp_path / "never")).count() == 0
    (tmp_path / "a" / "f").write_text("1")
    names = spark.createDataFrame([(str("file:" + str(tmp_path / "a" / "f")),), ("file:" + str(tmp_path / "gone"),)], "path string")
    assert objects.remove_objects(names) == 1 and not (tmp_path / "a" / "f").exists()


# --- manifests -------------------------------------------------------------------------------

DOC = "_record string, n bigint"


def docs(spark, pairs):
    return spark.createDataFrame(pairs, DOC)


def day(spark, base):
    schema = spark.createDataFrame([], DOC).schema
    return sorted((r._record, r.n) for r in landed.read_day(spark, landing.entity_dir(base, "video"), schema, "2024-1-1").collect())


def test_lost_merge_is_never_seen(spark, tmp_dir):
    old, new = [("a", 1), ("b", 2), ("c", 3)], [("b", 20), ("d", 40)]
    landing.land(docs(spark, old).repartition(3), tmp_dir, "video", day="2024-1-1")
    folder = landing.day_folder("video", "2024-1-1")
    landing.land(docs(spark, new), tmp_dir, "video", day="2024-1-1", merge=True, change=manifest.Change(spark, tmp_dir, [folder]))
    assert day(spark, tmp_dir) == old                                    # written, not committed
    target = landing.entity_dir(tmp_dir, "video")
    assert sorted(r.value for r in landed.read_lines(spark, target, "2024-1-1").collect()) == sorted(r.value for r in landed.read_lines(spark, target).collect())
    assert landed.read_lines(spark, target).count() == 3
    landing.land(docs(spark, new), tmp_dir, "video", day="2024-01-01", merge=True)
    merged = [("a", 1), ("b", 20), ("c", 3), ("d", 40)]
    assert day(spark, tmp_dir) == merged and manifest.stray(spark, tmp_dir).count() == 0 == manifest.vacuum(spark, tmp_dir, [folder])
    landing.land(docs(spark, [("z", 9)]), tmp_dir, "video", day="2024-1-1")                       # a plain landing replaces the managed day
    assert day(spark, tmp_dir) == [("z", 9)]
    landing.land(docs(spark, [("z", 10)]), tmp_dir, "video", day="2024-1-2", merge=True)
    assert day(spark, tmp_dir) == [("z", 9)]


def test_first_landing_of_a_day_by_merge_that_is_lost(spark, tmp_dir):
    landing.land(docs(spark, [("a", 1)]), tmp_dir, "video", day="2024-1-1", merge=True, change=manifest.Change(spark, tmp_dir, [landing.day_folder("video", "2024-1-1")]))
    assert day(spark, tmp_dir) == []
    landing.land(docs(spark, [("a", 2)]), tmp_dir, "video", day="2024-1-1", merge=True)
    assert day(spark, tmp_dir) == [("a", 2)]


def test_changes_of_one_folder_conflict_and_of_two_do_not(spark, tmp_dir):
    a, b = manifest.Change(spark, tmp_dir, ["x"]), manifest.Change(spark, tmp_dir, ["y"])
    c = manifest.Change(spark, tmp_dir, ["x"])
    for name in ("x", "y"):
        spark.range(5).write.mode("append").parquet(f"{tmp_dir}/{name}")
    assert a.commit() < b.commit("done")
    with pytest.raises(RuntimeError, match="another writer"):
        c.commit()
    assert manifest.marked(spark, tmp_dir, "done") and not manifest.marked(spark, tmp_dir, "other")
    assert warehouse.read_table(spark, tmp_dir, "x").count() == 5 == warehouse.read_table(spark, tmp_dir, "y").count()


def test_four_tables_become_visible_at_once(spark, tmp_dir):
    orders = spark.createDataFrame([(i, i % 3, "O", 1.0, dt.datetime(2024, 1, 1), "1-URGENT") for i in range(9)],
                                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    customers = spark.createDataFrame([(i, f"n{i}", 0, 1.0, "AUTO") for i in range(3)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    jobs.ingest_metadata(spark, standins.video_docs(orders), standins.channel_docs(customers), tmp_dir + "/landing", day="2024-1-1", run_ts=standins.RUN_TS)
    jobs.load_warehouse(spark, tmp_dir + "/landing", tmp_dir + "/wh", "2024-1-1")
    counts = {n: warehouse.read_table(spark, tmp_dir + "/wh", n).count() for n in jobs.LOAD_ORDER}
    assert counts["video"] == 9 and counts["thumbnail"] == 18
    change = manifest.Change(spark, tmp_dir + "/wh", jobs.LOAD_ORDER)
    warehouse.strict_load(spark, landing.entity_dir(tmp_dir + "/landing", "video"), jobs.WIRE_SCHEMA["video"], tmp_dir + "/wh/video", "2024-1-1")
    assert spark.read.parquet(tmp_dir + "/wh/video").count() == 18          # one of four tables is written, then the run is lost
    assert {n: warehouse.read_table(spark, tmp_dir + "/wh", n).count() for n in jobs.LOAD_ORDER} == counts
    change.abandon()


def test_compaction_clusters_and_replaces_at_once(spark, tmp_dir):
    for i in range(12):
        rows = spark.range(i * 500, i * 500 + 500).select(F.concat(F.lit("v"), F.md5(F.col("id").cast("string"))).alias("VideoID"), (F.col("id") * 7 % 1000).alias("ts"))
        warehouse.append(rows.repartition(3), tmp_dir + "/video")
    before = sorted(map(tuple, spark.read.parquet(tmp_dir + "/video").collect()))
    small = compaction.files(spark, tmp_dir, "video")
    total = small.agg(F.sum("length")).first()[0]
    assert small.count() == 36
    assert compaction.compact(spark, tmp_dir, "video", ["VideoID", "ts"], target_bytes=total // 4) == 36
    table = warehouse.read_table(spark, tmp_dir, "video")
    assert sorted(map(tuple, table.collect())) == before
    ranges = table.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("VideoID").alias("a"), F.max("VideoID").alias("b"), F.min("ts").alias("c"), F.max("ts").alias("d")).collect()
    assert 3 <= len(ranges) <= 8
    touched = [sum(r.a <= v <= r.b for r in ranges) for v in (x[0] for x in before[::400])]
    assert sum(touched) / len(touched) <= 0.8 * len(ranges)                    # a lookup's statistics leave files out
    one = table.where(F.col("VideoID") == before[7][0])
    assert "PushedFilters: [IsNotNull(VideoID), EqualTo(VideoID" in one._jdf.queryExecution().executedPlan().toString()
    assert compaction.compact(spark, tmp_dir, "video", ["VideoID"], target_bytes=64) == 0


# --- split reads -----------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_split_conditions_are_disjoint_and_complete(seed):
    rng = random.Random(seed)
    con = duckdb.connect()
    values = [None] * 20 + [7] * 400 + [rng.randint(-50, 50) for _ in range(300)]           # nulls and a hot key
    con.execute("CREATE TABLE q (k BIGINT, s BIGINT, name VARCHAR, d TIMESTAMP)")
    con.executemany("INSERT INTO q VALUES (?, ?, ?, ?)", [(v, rng.choice([None, *range(-9, 30)]), f"o'{v}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=v or 0)) for v in values])
    for column in ("k", "name", "d"):
        for spread in (None, "s"):
            for parts in (1, 2, 8, 40):
                bounds = [r[0] for r in con.execute(sql.bounds_query("SELECT * FROM q", column, parts)).fetchall()]
                conditions = sql.range_predicates(column, sorted(bounds), spread)
                sizes = [con.execute(f"SELECT count(*) FROM q WHERE {c}").fetchone()[0] for c in conditions]
                both = con.execute(f"SELECT count(*) FROM q WHERE {' + '.join(f'(CASE WHEN {c} THEN 1 ELSE 0 END)' for c in conditions)} <> 1").fetchone()[0]
                assert sum(sizes) == len(values) and both == 0, (column, spread, conditions)
                if spread and parts == 40 and column == "k":
                    assert max(sizes) < 120                                     # the hot key is dealt over several splits
    assert sum(con.execute(f"SELECT count(*) FROM q WHERE {c}").fetchone()[0] for c in sql.hash_predicates("s", 5)) == len(values)


def test_split_options():
    got = sql.split_options("postgres", "jdbc:postgresql://h/d", "SELECT * FROM t", ["a < 1", "a >= 1"], fetch_rows=77, user="u")
    assert got == {"url": "jdbc:postgresql://h/d", "table": "(SELECT * FROM t) q", "predicates": ["a < 1", "a >= 1"], "properties": {"fetchsize": "77", "user": "u"}}
    assert sql.range_predicates("a", []) == ["1 = 1"]
    with pytest.raises(sql.UnsupportedConnection):
        sql.split_options("google_cloud_platform", "", "SELECT 1", [])
    with pytest.raises(TypeError):
        sql.range_predicates("a", [True, False])


# --- Bloom probing ---------------------------------------------------------------------------

def test_probed_names_against_all_pairs(spark):
    rng = random.Random(4)
    alphabet = "abé東x"
    keys = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 14))) for _ in range(200)] + ["é", "東x", "Metadata/Video", "zz"]
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["", None, "Metadata/Video/2024/é.json", "z"]
    cand = spark.createDataFrame([(k,) for k in keys + [None]], "video_id string")
    listing = spark.createDataFrame([(n,) for n in names], "path string").repartition(4)
    want = sorted(k for k in keys if not any(k in n for n in names if n is not None))
    for method in ("bloom", "grams"):
        got = [r.video_id for r in eligibility.not_stored(cand, listing, method=method).collect()]
        assert sorted(k for k in got if k is not None) == want and got.count(None) == 1
    assert eligibility.not_stored(cand, listing.limit(0)).count() == len(keys) + 1
    assert eligibility.not_stored(cand.limit(0), listing).count() == 0


def test_an_empty_key_is_inside_any_name(spark):
    cand = spark.createDataFrame([("",), ("q",)], "video_id string")
    assert [r.video_id for r in eligibility.not_stored(cand, spark.createDataFrame([("name",)], "path string")).collect()] == ["q"]


def test_probing_passes_on_little_more_than_the_hits(spark):
    keys = spark.range(20_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 11).alias("video_id"))
    names = spark.range(5_000).select(F.concat(F.lit("Video/clips/2024-01-01/"), F.md5(F.concat(F.lit("n"), F.col("id").cast("string"))), F.lit(".mp4")).alias("path"))
    hits = keys.limit(30).select(F.concat(F.lit("Video/x_"), "video_id", F.lit(".mp4")).alias("path"))
    grams = bloom.windows(names.unionByName(hits), keys)
    assert 30 <= grams.count() < 100                 # of 5,000 names with 50 places each


# --- reasons ---------------------------------------------------------------------------------

def test_refusals_name_key_and_types(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("a bigint, b string")
    lines = {"bool": '{"a": true}', "text": '{"a": "x"}', "more": '{"a": 1, "zzz": 2, "yyy": 3}', "nested": '{"b": {"c": 1}}', "torn": '{"a": ', "list": "[1]", "good": '{"a": 1}'}
    for name, line in lines.items():
        (tmp_path / f"{name}.json").write_text('{"b": "fine"}\n' + line + "\n")
    _, report = warehouse.strict_load(spark, str(tmp_path), schema)
    got = {r.file_name[:-5]: r.reason and tuple(r.reason) for r in report.collect()}
    assert got.pop("good") is None and got["torn"] == (None, "object", "malformed") and got["more"] == ("yyy", "no such key", "a value")
    assert got["bool"] == ("a", "bigint", "BOOLEAN") and got["text"] == ("a", "bigint", "STRING")
    assert got["nested"][:2] == ("b", "string") and got["nested"][2].startswith("OBJECT") and got["list"][1] == "object" and got["list"][2].startswith("ARRAY")
