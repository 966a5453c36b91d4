"""As-of join, interval joins, sketches, sessions: against plain loops, with hot keys over many tasks."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import asof, carried, intervals, sketches
from reelhouse.streaming import sessions

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


@pytest.fixture
def many_tasks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot", [False, True])
def test_asof_against_loops(spark, many_tasks, hot):
    rng = random.Random(hot)
    users = [1] * 8 + [2, 3] if hot else list(range(12))
    obs = [(rng.choice([*users, None]), rng.choice([None, *range(0, 3000, 7)]), rng.randint(0, 9)) for _ in range(60 if hot else 300)]
    events = [(i, rng.choice([*users, None, 99]), rng.choice([None, *range(-20, 3000, 3)])) for i in range(500)]
    events += events[:20]
    got = asof.asof_join(spark.createDataFrame([(i, u, at(m)) for i, u, m in events], "id long, u long, t timestamp").withColumn("k", F.lit("own")),
                         spark.createDataFrame([(u, at(m), v) for u, m, v in obs], "u long, t timestamp, v long"), "u", "t", ["v"])
    want = Counter()
    for i, u, m in events:
        best = max(((om, v) for ou, om, v in obs if u is not None and m is not None and ou == u and om is not None and om <= m), default=(None, None))
        want[i, u, at(m), "own", at(best[0]), best[1]] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_hot_key_is_spread_over_tasks(spark, many_tasks):
    log = carried.ranged(spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("t")), "k", "t")
    sizes = [r["count"] for r in log.groupBy("shard").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 1200


@pytest.mark.parametrize("seed", range(3))
def test_points_in_intervals_against_loops(spark, seed):
    rng = random.Random(seed)
    wide = [(0, -10**15, 10**15), (1, -5, 4_000_000), (2, 7, 7), (3, 9, 3), (4, None, 5), (5, 5, None)]
    spans = wide + [(10 + i, s := rng.randint(-3000, 3000), s + rng.choice([1, 2, 5, 40, 900])) for i in range(150)]
    points = [(i, rng.choice([None, *range(-3200, 3200)])) for i in range(400)] + [(900 + i, 17) for i in range(50)]
    got = intervals.points_in_intervals(spark.createDataFrame(points, "id long, p long"), spark.createDataFrame(spans, "id long, s long, e long"), "p", "s", "e",
                                        None if seed else 1)
    pairs = Counter((r.point.id, r.interval.id) for r in got.collect())
    want = Counter((i, j) for i, p in points for j, s, e in spans if None not in (p, s, e) and s <= p < e)
    assert pairs == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_very_long_interval_has_few_pieces(spark):
    df = spark.createDataFrame([(-10**15 + 1, 10**15 - 1)], "low long, high long")
    pieces = df.select(F.explode(intervals.cover("low", "high")).alias("x")).select("x.*").collect()
    assert len(pieces) <= 2 * 52 and sum(1 << r.level for r in pieces) == 2 * 10**15 - 2
    assert sorted((r.bin << r.level, (r.bin + 1) << r.level) for r in pieces)[0][0] == -10**15 + 1


def test_overlapping_intervals_against_loops(spark):
    rng = random.Random(9)
    one, two = ([(i, s := rng.randint(0, 900), s + rng.choice([0, 1, 10, 300])) for i in range(120)] for _ in range(2))
    got = intervals.overlapping(spark.createDataFrame(one, "id long, s long, e long"), spark.createDataFrame(two, "id long, s long, e long"), "s", "e")
    assert Counter((r.a.id, r.b.id) for r in got.collect()) == Counter((i, j) for i, s, e in one for j, u, v in two if s < e and u < v and s < v and u < e)


def test_sketches_of_loads_answer_as_a_rebuild_and_within_bounds(spark, tmp_dir):
    rows = spark.range(60_000).select((F.col("id") % 6).alias("d"), F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("e"),
                                      (F.xxhash64("id") % 9000).alias("u"), (F.col("id") * 37 % 1000).cast("double").alias("x"), (F.col("id") % 50).alias("v"))
    columns = {"day": "d", "entity": "e", "distinct": "u", "number": "x", "value": "v"}
    table = tmp_dir + "/s"
    for load, part in (("a", rows.where("d < 3")), ("b", rows.where("d >= 3 AND x < 900")), ("late", rows.where("d >= 3 AND x >= 900"))):
        for _ in range(2):                       # a load that is retried counts once
            sketches.add_load(part, table, load, **columns)
    stored, rebuilt = sketches.read_table(spark, table), sketches.sketch_rows(rows, **columns)
    assert stored.count() > rebuilt.count()
    exact = {r.e: r for r in rows.where("d BETWEEN 1 AND 4").groupBy("e").agg(F.count_distinct("u").alias("u"), F.count(F.lit(1)).alias("n")).collect()}
    for sk in (stored, rebuilt):
        got = {r.e: r for r in sketches.answers(sketches.day_range(sk, 1, 4).withColumnRenamed("entity", "e"), "e", quantiles=(0.1, 0.5, 0.9)).collect()}
        assert got.keys() == exact.keys()
        for e, r in got.items():
            assert r.n_rows == exact[e].n and abs(r.n_distinct - exact[e].u) <= 0.03 * exact[e].u
            assert all(abs(q / 1000 - want) <= 0.03 for q, want in zip(r.quantiles, (0.1, 0.5, 0.9), strict=True))
            assert len(r.top) == 3
    assert sketches.answers(stored.limit(0), "entity").count() == 0


def plain_sessions(rows, gap):
    out, of = Counter(), {}
    for u, m, v in rows:
        if u is not None and m is not None:
            of.setdefault(u, []).append((m, v or 0))
    for u, own in of.items():
        run = []
        for m, v in sorted(own):
            if run and m - run[-1][0] > gap:
                out[u, at(run[0][0]), at(run[-1][0]), len(run), sum(x for _, x in run)] += 1
                run = []
            run.append((m, v))
        out[u, at(run[0][0]), at(run[-1][0]), len(run), sum(x for _, x in run)] += 1
    return out


def visits(seed, n=700):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 1, 1, 2, 3, 4, None]), rng.choice([None, *range(0, 9000)]), rng.choice([None, *range(9)])) for _ in range(n)]


def framed(spark, rows):
    return spark.createDataFrame([(u, at(m), v) for u, m, v in rows], "u long, t timestamp, v long")


def test_sessions_against_loops(spark, many_tasks):
    rows = visits(1) + [(7, m, 1) for m in range(0, 6000, 5)]            # one session over many tasks
    got = sessions.sessions(framed(spark, rows), "u", "t", "v", "10 minutes")
    assert Counter((r.key, r.first, r.last, r.n, int(r.total)) for r in got.collect()) == plain_sessions(rows, 10)
    assert sessions.sessions(framed(spark, []), "u", "t", "v", "10 minutes").count() == 0


def test_folding_long_partial_sessions_over_later_short_ones(spark, many_tasks):
    parts = [(1, at(0), at(500), 5)] + [(1, at(m), at(m), 1) for m in range(3, 499, 4)] + [(1, at(900), at(901), 2), (2, at(1), at(2), 1)]
    df = spark.createDataFrame(parts, "key long, first timestamp, last timestamp, n long").withColumn("total", F.lit(0).cast("decimal(38,6)"))
    got = {(r.key, r.first, r.last, r.n) for r in sessions.fold(df, "1 minute").collect()}
    assert got == {(1, at(0), at(500), 129), (1, at(900), at(901), 2), (2, at(1), at(2), 1)}


def test_session_stream_in_any_order_and_after_a_lost_batch(spark, tmp_dir, monkeypatch):
    rows = visits(3, 300)
    schema = framed(spark, []).schema
    args = (tmp_dir + "/src", schema, tmp_dir + "/table", tmp_dir + "/ckpt", "u", "t", "v", "30 minutes")
    random.Random(5).shuffle(rows)
    commit = sessions.manifest.Change.commit
    for i in range(3):
        framed(spark, rows[i::3]).write.mode("append").json(tmp_dir + "/src")
        if i == 1:
            def lost(self, mark=None):
                commit(self, mark)
                raise RuntimeError("driver lost after the commit")
            monkeypatch.setattr(sessions.manifest.Change, "commit", lost)
            with pytest.raises(Exception, match="driver lost"):
                sessions.load_sessions(spark, *args)
            monkeypatch.setattr(sessions.manifest.Change, "commit", commit)
        sessions.load_sessions(spark, *args)
    got = sessions.read_sessions(spark, tmp_dir + "/table", "key long, first timestamp, last timestamp, n long, total decimal(38,6)")
    assert Counter((r.key, r.first, r.last, r.n, int(r.total)) for r in got.collect()) == plain_sessions(rows, 30)
