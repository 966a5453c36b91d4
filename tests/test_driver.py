"""Driver contract: entry smoke, registry shape, every query equal to its DuckDB oracle."""

import importlib.util
import os

import duckdb
import pytest

from tools.check_oracle import rows_of

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["VideoID", "n_images", "max_width"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from reelhouse.plans.queries import QUERIES
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(QUERIES) >= 38


@pytest.fixture(scope="module")
def duck():
    from reelhouse.plans.queries import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    s, scols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry_mod.oracle_sql()[name])
    o, ocols = rows_of([c[0] for c in res.description], res.fetchall())
    assert scols == ocols
    assert len(s) == len(o)
    assert s == o
