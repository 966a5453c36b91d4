"""J9: SQL value gate (GATE-1/2, SRC-8, LIM-1, FLT-7, FN-16, UDF-1/2).

The query runs on Spark with bound parameters; only its first cell is
fetched (``limit(1)``). Order of checks, as in the rebuilt sensor:

1. no row -> ``False``, or :class:`GateError` when ``fail_on_empty``;
2. ``failure(cell)`` true -> :class:`GateError`;
3. ``success`` given -> return ``success(cell)`` (the action does not run);
4. otherwise run ``action()`` when the cell is truthy, return its truth.

Non-callable ``success`` / ``failure`` are rejected up front with
``TypeError``. A truthy cell without an action just returns ``True``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import truthy


class GateError(RuntimeError):
    pass


def gate_frame(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """First row of the query with its first cell and that cell's truth value."""
    df = spark.sql(sql, args=args)
    first = df.schema.fields[0]
    return df.limit(1).select(F.col(f"`{first.name}`").alias("cell"),
                              truthy(F.col(f"`{first.name}`"), first.dataType).alias("passed"))


def sql_gate(spark: SparkSession, sql: str, args: dict | list | None = None,
             action: Callable[[], Any] | None = None,
             success: Callable[[Any], Any] | None = None,
             failure: Callable[[Any], Any] | None = None,
             fail_on_empty: bool = False) -> bool:
    for name, fn in (("failure", failure), ("success", success)):
        if fn is not None and not callable(fn):
            raise TypeError(f"{name} has to be a function of the cell, not {fn!r}")
    rows = spark.sql(sql, args=args).limit(1).collect()
    if not rows:
        if fail_on_empty:
            raise GateError("the query gave no row, and this gate asks for one")
        return False
    cell = rows[0][0]
    if failure is not None and failure(cell):
        raise GateError(f"the gate is closed by its failure test on {cell!r}")
    if success is not None:
        return bool(success(cell))
    passed = bool(cell)
    if passed and action is not None:
        action()
    return passed
