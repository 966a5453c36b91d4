"""Plan checks on the driver queries: pruning, pushdown, codegen, join strategies."""

import os

import pytest

from reelhouse.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan_of(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(spark, "first_page_feed")
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan  # no text
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(n_chars), EqualTo(lang,en)]" in plan


def test_gate_query_filter_is_pushed(spark):
    plan = plan_of(spark, "sql_gate_cell")
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderstatus:string>" in plan


def test_day_load_prunes_partitions(spark):
    plan = plan_of(spark, "date_prefix_load")
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "= 2024-1-1)" in plan


def test_entity_plans_are_codegen_and_python_free(spark):
    import re
    for name in ("video_rows", "caption_rows", "channel_rows_per_video"):
        df = QUERIES[name](spark, SF)
        df.collect()                                   # AQE builds codegen stages as it runs
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and re.search(r"\*\(\d+\) ", final), name
        plan = plan_of(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_equality_plan_for_substring_anti_join(spark):
    plan = plan_of(spark, "not_stored_ngram")
    assert "NestedLoopJoin" not in plan and "HashJoin" in plan
