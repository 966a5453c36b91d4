"""Crowded bins of interval joins over many tasks; compaction and merges whose tasks are bounded."""

from pyspark.sql import functions as F

from reelhouse.operators import intervals
from reelhouse.sinks import compaction, warehouse


def test_a_crowded_bin_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CELL", 20, raising=False)
    points = spark.range(0, 200, 1, 1).select("id", F.lit(5).cast("bigint").alias("p"), F.create_map("id", "id").alias("more"))
    spans = spark.range(0, 150, 1, 1).select(F.col("id").alias("no"), F.lit(0).cast("bigint").alias("s"), F.when(F.col("id") < 140, 10).otherwise(5).cast("bigint").alias("e"))
    met = intervals.points_in_intervals(points.unionByName(points.where("id = 0")).coalesce(1), spans, "p", "s", "e")
    parts = met.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 201 * 140 and max(r["count"] for r in parts) < 201 * 140 / 2
    pairs = met.groupBy("point.id", "interval.no").count().collect()
    assert len(pairs) == 200 * 140 and all(r["count"] == (2 if r.id == 0 else 1) for r in pairs)
    assert met.where("point.more[point.id] = point.id").count() == 201 * 140
    assert intervals.points_in_intervals(points, spans.where("no < 0"), "p", "s", "e").count() == 0


def test_compacted_files_are_bounded_by_their_rows(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(compaction, "SORTED_BYTES", 200_000, raising=False)
    rows = spark.range(0, 6000, 1, 6).select("id", F.lit("the same text").alias("text"), F.array(F.lit("x")).alias("list"))
    for _ in range(2):
        warehouse.append(rows, tmp_dir + "/t")
    assert compaction.compact(spark, tmp_dir, "t", ["id", "text"]) == 12
    table = warehouse.read_table(spark, tmp_dir, "t")
    assert sorted(r.id for r in table.collect()) == sorted(2 * list(range(6000)))
    per_file = [r["count"] for r in table.groupBy(F.col("_metadata.file_name")).count().collect()]
    assert 4 <= len(per_file) < 12 and max(per_file) < 4000
    assert compaction.compact(spark, tmp_dir, "t", ["id", "text"]) == 0        # few bytes, but full
