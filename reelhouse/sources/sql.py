"""SQL sources: Spark SQL over registered views (SRC-7/8) and JDBC by type (SRC-9, SRC-12).

For a database connection the query is pushed whole to the database
and fetched in batches of ``fetchsize`` rows, the
counterpart of the original cursor ``arraysize``; a large result is read in
many tasks, each with a condition on a split column. Connector jars other
than JDBC drivers are not bundled; the option builder still rejects an
unknown connection type up front.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Connection types the rebuilt sensor accepts (fixed values).
ALLOWED_CONN_TYPES = frozenset({
    "google_cloud_platform", "jdbc", "mssql", "mysql", "odbc",
    "oracle", "postgres", "presto", "sqlite", "vertica",
})
DEFAULT_FETCH_ROWS = 1000


class UnsupportedConnection(ValueError):
    pass


def register_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Parquet tables as temp views (the 'connection' for SQL-1 text)."""
    for n in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet").createOrReplaceTempView(n)


def run_sql(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """SRC-7 / SRC-8: any query text, parameters bound by Spark (no string splicing)."""
    return spark.sql(sql, args=args)


def source_options(conn_type: str, url: str, query: str, fetch_rows: int = DEFAULT_FETCH_ROWS,
                   **extra: str) -> tuple[str, dict[str, str]]:
    """(format, options) for a connection type; unknown types raise."""
    if conn_type not in ALLOWED_CONN_TYPES:
        raise UnsupportedConnection(
            f"connection type {conn_type!r} is not supported; use one of {sorted(ALLOWED_CONN_TYPES)}")
    if conn_type == "google_cloud_platform":
        return "bigquery", {"query": query, "viewsEnabled": "true", **extra}
    return "jdbc", {"url": url, "query": query, "fetchsize": str(fetch_rows), **extra}


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise TypeError(f"not a bound: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def bounds_query(query: str, column: str, parts: int) -> str:
    """Query text for the first key of each of ``parts`` equal shares of the rows (at most ``parts`` rows), in order."""
    return (f"SELECT MIN(k) AS k FROM (SELECT {column} AS k, NTILE({int(parts)}) OVER (ORDER BY {column}) AS share FROM ({query}) q WHERE {column} IS NOT NULL) s "
            f"GROUP BY share ORDER BY share")


def hash_predicates(column: str, parts: int) -> list[str]:
    """Conditions that deal a whole-number column into ``parts`` splits; nulls are in the first."""
    own = [f"MOD(ABS({column}), {parts}) = {i}" for i in range(parts)]
    return [f"({own[0]} OR {column} IS NULL)", *own[1:]] if parts > 1 else ["1 = 1"]


def range_predicates(column: str, bounds: list, spread: str | None = None) -> list[str]:
    """Disjoint conditions that cover every row, from the shares' first keys (``bounds_query``).

    The first split is open below and takes the nulls, the last is open above. A key that begins several shares holds as many
    shares of the rows: with ``spread``, a whole-number column, that key alone is dealt over so many splits by it.
    """
    starts = sorted(set(bounds))
    if not starts:
        return ["1 = 1"]
    out = []
    for i, first in enumerate(starts):
        low = f"{column} >= {_literal(first)}" if i else None
        high = f"{column} < {_literal(starts[i + 1])}" if i + 1 < len(starts) else None
        times = bounds.count(first)
        if spread and times > 1:
            out += [f"{column} = {_literal(first)} AND {p}" for p in hash_predicates(spread, times)]
            low = f"{column} > {_literal(first)}"
            if not i:
                out.append(f"({column} < {_literal(first)} OR {column} IS NULL)")
        elif not i:
            out.append(f"({high} OR {column} IS NULL)" if high else "1 = 1")
            continue
        out.append(" AND ".join(x for x in (low, high) if x))
    return out


def split_options(conn_type: str, url: str, query: str, predicates: list[str], fetch_rows: int = DEFAULT_FETCH_ROWS,
                  **extra: str) -> dict:
    """Arguments of ``DataFrameReader.jdbc`` that read the query in one task for each condition."""
    fmt, options = source_options(conn_type, url, query, fetch_rows, **extra)
    if fmt != "jdbc":
        raise UnsupportedConnection(f"{conn_type!r} splits its reads by itself")
    properties = {k: v for k, v in options.items() if k not in ("url", "query")}
    return {"url": url, "table": f"({query}) q", "predicates": predicates, "properties": properties}


def read_connection(spark: SparkSession, conn_type: str, url: str, query: str,
                    fetch_rows: int = DEFAULT_FETCH_ROWS, split_by: str | None = None, parts: int = 1,
                    spread: str | None = None, **extra: str) -> DataFrame:
    """The rows of a query over a connection.

    With ``split_by`` the database is first asked for the bounds of ``parts`` equal shares of that column, and each share is
    read by a task of its own (``range_predicates``); without, one task reads the whole result.
    """
    fmt, opts = source_options(conn_type, url, query, fetch_rows, **extra)
    if split_by is None or fmt != "jdbc" or parts < 2:
        return spark.read.format(fmt).options(**opts).load()
    _, ask = source_options(conn_type, url, bounds_query(query, split_by, parts), fetch_rows, **extra)
    bounds = [r[0] for r in spark.read.format("jdbc").options(**ask).load().collect()]        # at most `parts` rows
    return spark.read.jdbc(**split_options(conn_type, url, query, range_predicates(split_by, sorted(bounds), spread), fetch_rows, **extra))


# SRC-12: the warehouse, object-store and document-store connectors of the
# original are thin wrappers; here they are reader/writer formats + options.
CONNECTOR_FORMATS = {"warehouse": "bigquery", "document_store": "mongodb", "object_store": None}


def connector_reader(spark: SparkSession, kind: str, path: str | None = None, fmt: str | None = None,
                     **options: str):
    """A DataFrameReader for a connector kind (object store = file formats on its URI)."""
    if kind not in CONNECTOR_FORMATS:
        raise UnsupportedConnection(f"unknown connector kind {kind!r}")
    reader = spark.read.options(**options)
    if kind == "object_store":
        return reader.format(fmt or "parquet").load(path) if path else reader.format(fmt or "parquet")
    return reader.format(CONNECTOR_FORMATS[kind])
