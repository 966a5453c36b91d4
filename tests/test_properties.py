"""Property-based checks against plain-Python reference behaviour."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelhouse.functions import exprs
from reelhouse.operators import eligibility

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

paths = st.text(alphabet="/ab.", max_size=8)


@SLOW
@given(st.lists(paths, min_size=1, max_size=20))
def test_base_dir_name(spark, ps):
    df = spark.createDataFrame([(p,) for p in ps], "p string")
    for r in df.select("p", exprs.base_name("p").alias("b"), exprs.dir_name("p").alias("d")).collect():
        assert (r.b, r.d) == (os.path.basename(r.p), os.path.dirname(r.p))


@SLOW
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=10),
       st.lists(st.one_of(st.none(), st.text(alphabet="0a ", max_size=2)), min_size=1, max_size=10))
def test_truthy_matches_bool(spark, ints, strs):
    from pyspark.sql import types as T
    di = spark.createDataFrame([(x,) for x in ints], "x int")
    ds = spark.createDataFrame([(x,) for x in strs], "x string")
    for df, dtype, vals in ((di, T.IntegerType(), ints), (ds, T.StringType(), strs)):
        got = [r.t for r in df.select(exprs.truthy("x", dtype).alias("t")).collect()]
        assert got == [bool(v) for v in vals]


@SLOW
@given(st.lists(st.text(alphabet="abc", min_size=0, max_size=3), min_size=1, max_size=8),
       st.lists(st.text(alphabet="abc/", max_size=6), min_size=0, max_size=8))
def test_ngram_plan_equals_substring_rule(spark, keys, names):
    cand = spark.createDataFrame([(k,) for k in keys], "video_id string")
    listing = spark.createDataFrame([(n,) for n in names], "path string")
    expected = sorted(k for k in keys if not any(k in n for n in names))
    got = sorted(r.video_id for r in eligibility.not_stored(cand, listing).collect())
    assert got == expected
