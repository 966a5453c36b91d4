"""J9: the SQL gate truth table."""

import pytest

from reelhouse.operators.gate import GateError, gate_frame, sql_gate


def q(value_sql):
    return f"SELECT {value_sql} AS v"


@pytest.mark.parametrize("value_sql, expected", [
    ("0", False), ("1", True), ("'0'", True), ("''", False), ("CAST(NULL AS INT)", False), ("2.5", True),
    ("true", True), ("false", False),
])
def test_truthiness(spark, value_sql, expected):
    assert sql_gate(spark, q(value_sql)) is expected
    assert gate_frame(spark, q(value_sql)).first().passed is expected


def test_no_row(spark):
    empty = "SELECT 1 AS v WHERE false"
    assert sql_gate(spark, empty) is False
    with pytest.raises(GateError):
        sql_gate(spark, empty, fail_on_empty=True)
    assert gate_frame(spark, empty).count() == 0


def test_failure_success_and_action(spark):
    calls = []
    with pytest.raises(GateError):
        sql_gate(spark, q("5"), failure=lambda c: c > 3)
    # success given: its value is returned and the action does not run
    assert sql_gate(spark, q("5"), success=lambda c: c == 4, action=lambda: calls.append(1)) is False
    assert calls == []
    assert sql_gate(spark, q("5"), action=lambda: calls.append(1)) is True and calls == [1]
    assert sql_gate(spark, q("0"), action=lambda: calls.append(2)) is False and calls == [1]
    assert sql_gate(spark, q("7")) is True                               # truthy without an action


def test_non_callable_rejected(spark):
    with pytest.raises(TypeError):
        sql_gate(spark, q("1"), success=True)
    with pytest.raises(TypeError):
        sql_gate(spark, q("1"), failure="x")


def test_bound_parameters(spark):
    spark.range(10).createOrReplaceTempView("ten")
    assert sql_gate(spark, "SELECT count(*) FROM ten WHERE id > :n", args={"n": 8}) is True
    assert sql_gate(spark, "SELECT count(*) FROM ten WHERE id > :n", args={"n": 9}) is False


def test_connection_types():
    from reelhouse.sources.sql import UnsupportedConnection, source_options
    fmt, opts = source_options("postgres", "jdbc:postgresql://db/x", "SELECT 1")
    assert fmt == "jdbc" and opts["fetchsize"] == "1000" and opts["query"] == "SELECT 1"
    with pytest.raises(UnsupportedConnection):
        source_options("mongo", "u", "q")


def test_connector_kinds(spark, tmp_path):
    from reelhouse.sources.sql import UnsupportedConnection, connector_reader
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert connector_reader(spark, "object_store", str(tmp_path / "t")).count() == 3
    with pytest.raises(UnsupportedConnection):
        connector_reader(spark, "queue")


def test_shared_folder_required_off_local(spark):
    from reelhouse.session import checkpoint_root
    assert checkpoint_root(spark)            # local mode: a private folder is fine


def test_positional_parameters(spark):
    assert sql_gate(spark, "SELECT ? > 3 AS v", args=[5]) is True
    assert gate_frame(spark, "SELECT ? AS v", args=["0"]).first().passed is True   # bool('0') is True
