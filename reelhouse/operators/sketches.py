"""Stored sketches: distinct counts, quantiles and frequent values of any range of days, without reading its rows.

A sketch table has one row for each (day, entity): the number of rows, a HyperLogLog sketch of one column, a KLL sketch of a number and
a frequent-items sketch of a value. Sketches are merged, not recomputed: a range of days, or all entities, is a merge of rows whose size doesn't
depend on the rows behind them. Building is map-side combined, so a day or an entity with a third of all rows is no hot key.

The table is kept up to date by adding: the rows of a load make sketch rows of their own (``load`` says of which), written in
overwrite mode, so a load that is retried replaces its own. Late days are further rows of an old day. Distinct counts and quantiles merge in any
order to the same error bounds, so a table built by loads answers as one rebuilt from all rows does.

Errors: distinct counts have a relative standard error of about 1.04 / sqrt(2 ** LG_K) (0.8 %), exact for small sets; a quantile's rank is off by
about 1 % of the rows; frequent values are exact as long as the merged rows have at most `FREQUENT` values. Beyond, the sketch may name none at all: where all values are
about as frequent, none exceeds its error. So the loads also store how often each value occurs by day and entity (``read_values``), one narrow row for each value instead of
its rows; ``answers`` takes the frequent values of groups with more than `FREQUENT` from there, exactly.
Null days and entities are groups of their own. Nulls in the measured columns count for nothing. Empty tables give empty answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LG_K, FREQUENT = 14, 1_000
LOAD = "load"


def sketch_rows(rows: DataFrame, day: str, entity: str, distinct: str, number: str, value: str) -> DataFrame:
    """One row for each day and entity of ``rows``."""
    return rows.groupBy(F.col(day).alias("day"), F.col(entity).alias("entity")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(distinct, LG_K).alias("distinct"),
        F.kll_sketch_agg_double(F.col(number).cast("double")).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(`{value}`, {FREQUENT})").alias("frequent"))


def value_rows(rows: DataFrame, day: str, entity: str, value: str, **_: str) -> DataFrame:
    """(day, entity, value, n): how often each value occurs; null is one, as in the sketch."""
    keys = [F.col(day).alias("day"), F.col(entity).alias("entity"), F.col(value).alias("value")]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _values_path(table: str) -> str:
    return f"{table.rstrip('/')}_values"


def add_load(rows: DataFrame, table: str, load: str, **columns: str) -> None:
    """Write the sketches and value counts of one load's rows to the table; the same load again replaces them."""
    value_rows(rows, **columns).write.mode("overwrite").parquet(f"{_values_path(table)}/{LOAD}={load}")
    sketch_rows(rows, **columns).write.mode("overwrite").parquet(f"{table.rstrip('/')}/{LOAD}={load}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table)


def read_values(spark: SparkSession, table: str) -> DataFrame:
    """The value counts beside the table's sketches (``value_rows``)."""
    return spark.read.parquet(_values_path(table))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches of each group of ``by`` (of all rows without), merged."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("distinct").alias("distinct"),
                                     F.kll_merge_agg_double("quantiles").alias("quantiles"), F.expr(f"approx_top_k_combine(frequent, {FREQUENT})").alias("frequent"))


def _exact_top(values: DataFrame, by: tuple[str, ...], top: int) -> DataFrame:
    """(by.., exact_top) of the groups with more than `FREQUENT` values. Each task passes on its ``top`` values of a group only."""
    counts = values.groupBy(*by, "value").agg(F.sum("n").alias("n"))
    many = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_values"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "value"))
    first = counts.withColumn("rank", rank).where(F.col("rank") <= top).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("value").alias("item"), F.col("n").alias("count")))).alias("first"))
    exact = F.transform("first", lambda x: F.struct(x["item"].alias("item"), x["count"].alias("count")))
    return _beside(many.where(F.col("n_values") > FREQUENT), first, by, "inner").select(*by, exact.alias("exact_top"))


def _beside(a: DataFrame, b: DataFrame, by: tuple[str, ...], how: str) -> DataFrame:
    """Rows of equal groups beside each other; null is a group."""
    if not by:
        return a.join(b, F.lit(True), how)
    b = b.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in b.columns if c not in by])
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return a.join(b, on, how).drop(*[f"_{c}" for c in by])


def answers(sketches: DataFrame, *by: str, quantiles: tuple[float, ...] = (0.5,), top: int = 3, values: DataFrame | None = None) -> DataFrame:
    """(by.., n_rows, n_distinct, quantiles array, top array of (item, count)) of the merged groups.

    With the ``values`` of the same days, ``top`` is exact for groups of more than `FREQUENT` values too; without, it has those that the sketch is sure of, perhaps none.
    """
    ranks = F.array(*[F.lit(q) for q in quantiles])
    out = merged(sketches, *by).select(*by, "n_rows", F.hll_sketch_estimate("distinct").alias("n_distinct"),
                                       F.kll_sketch_get_quantile_double("quantiles", ranks).alias("quantiles"), F.expr(f"approx_top_k_estimate(frequent, {top})").alias("top"))
    if values is None:
        return out
    return _beside(out, _exact_top(values, by, top), by, "left").withColumn("top", F.coalesce("exact_top", "top")).drop("exact_top")


def day_range(sketches: DataFrame, first, last) -> DataFrame:
    """The sketch rows of the days from ``first`` to ``last``, both included."""
    return sketches.where(F.col("day").between(F.lit(first), F.lit(last)))
