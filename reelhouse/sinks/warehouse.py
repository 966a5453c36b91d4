"""J3 strict warehouse load: landed NDJSON -> append-only table + per-file report.

Spark's FAILFAST JSON mode accepts arrays/objects in string columns and
silently drops unknown fields, so strictness is checked per line on a
VARIANT parse of the line (H3):

* malformed JSON or a non-object line         -> bad
* a key that is not in the schema (exact case) -> bad
* an array / object where a scalar is declared -> bad
* a boolean in a numeric column               -> bad
* a value an integer / float column cannot hold (quoted integers are
  coerced; fractions in an integer column are not) -> bad
* missing keys and JSON nulls                 -> null (every column is nullable)

A file with any bad line loads no rows and reports ``failed``; the others
load and report ``loaded``; a file without a line reports ``loaded`` with no
rows. ``fail_fast=True`` raises on the first failed file instead. The report
is one aggregate row per file; the load leaves out the failed files.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, work_dir
from ..sinks import manifest
from ..sinks.landing import DAY_COL, LANDING_FIELDS, day_text
from ..sources.landed import read_lines


REASON = "struct<key:string,expected:string,found:string>"


class LoadError(RuntimeError):
    pass


def _field_bad(v: Column, f: T.StructField) -> Column:
    path = f"$.{f.name}"
    sub = F.variant_get(v, path, "variant")
    kind = F.schema_of_variant(sub)
    present = sub.isNotNull() & (kind != F.lit("VOID"))
    dt = f.dataType
    if isinstance(dt, T.VariantType):
        return F.lit(False)
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    if isinstance(dt, T.StringType):
        return present & nested
    if isinstance(dt, T.NumericType):
        nested = nested | (kind == "BOOLEAN")   # a cast would read true as 1
    if isinstance(dt, (T.LongType, T.IntegerType)):
        as_int = F.try_variant_get(v, path, dt.simpleString())
        as_dec = F.try_variant_get(v, path, "decimal(38,9)")
        whole = as_int.isNotNull() & (as_dec.isNull() | (as_dec == as_int.cast("decimal(38,9)")))
        return present & (nested | ~whole)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return present & (nested | F.try_variant_get(v, path, "double").isNull())
    if isinstance(dt, T.BooleanType):
        return present & (nested | F.try_variant_get(v, path, "boolean").isNull())
    return present & F.try_variant_get(v, path, dt.simpleString()).isNull()


def line_checks(lines: DataFrame, schema: T.StructType, extra_fields: tuple[str, ...] = LANDING_FIELDS) -> DataFrame:
    """Adds ``v`` (VARIANT of the line) and ``is_bad`` to a ``value`` text column.

    ``extra_fields`` are landing-format keys that are allowed and not loaded.
    """
    expected = F.array(*[F.lit(f.name) for f in schema.fields], *[F.lit(x) for x in extra_fields])
    parsed = lines.withColumn("v", F.try_parse_json(F.col("value")))
    names, v, plain = parsed.columns, F.col("v"), _plain_line(F.col("value"), schema, extra_fields)
    if plain is not None:
        # Only the other lines are parsed for the checks; who needs no values then parses nothing of a plain line.
        parsed = parsed.withColumn("_plain", F.coalesce(plain, F.lit(False))).withColumn("_v", F.when(~F.col("_plain"), F.try_parse_json("value")))
        v = F.col("_v")
    # Keys from the parsed value (no second parse of the text); null unless an object.
    keys = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
    bad = v.isNull() | keys.isNull() | (F.size(F.array_except(keys, expected)) > 0)
    for f in schema.fields:
        bad = bad | _field_bad(v, f)
    bad = F.coalesce(bad, F.lit(True))
    parsed = parsed.withColumn("is_bad", bad if plain is None else F.when(F.col("_plain"), F.lit(False)).otherwise(bad))
    return parsed.withColumn("reason", F.when(F.col("is_bad"), _reason(v, keys, expected, schema))).select(*names, "is_bad", "reason")


def _plain_line(text: Column, schema: T.StructType, extra_fields: tuple[str, ...]) -> Column | None:
    """True for lines whose text alone shows that they are good; a good line need not be plain. None if the schema has other types.

    Plain lines are JSON objects as the landing writes them: the known keys in order, each at most once, without blanks between, with
    scalars of the declared type. Their strings are ASCII and hold no quote; what a backslash may start is checked by itself.
    """
    number = "-?(?:0|[1-9][0-9]{0,17})"
    string = r'"[ !#-~]*+(?<!\\)"'
    kinds = {T.StringType: string, T.LongType: number, T.DoubleType: number + r"(?:\.[0-9]{1,18})?(?:E-?[0-9]{1,2})?", T.BooleanType: "true|false"}
    fields = [(x, T.StringType) for x in extra_fields if x not in schema.names] + [(f.name, type(f.dataType)) for f in schema.fields]
    if not all(kind in kinds and re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) for name, kind in fields):
        return None
    line = "".join(f'(?:"{name}":(?:null|{kinds[kind]})(?:,(?=")|(?=\\}})))?' for name, kind in fields)
    escapes = r'\\(?![\\/bfnrt]|u(?![dD][89a-fA-F])[0-9a-fA-F]{4})'     # an unpaired surrogate is left to the parser
    return (F.octet_length(text) < 1_000_000) & text.rlike(r"^\{" + line + r"\}\z") & (~text.contains("\\") | ~text.rlike(escapes))


def _reason(v: Column, keys: Column, expected: Column, schema: T.StructType) -> Column:
    """Why a bad line is refused: (key, expected, found) of the first fault, in the order of the checks."""
    def why(key: Column, wanted: str, found: Column) -> Column:
        return F.struct(key.alias("key"), F.lit(wanted).alias("expected"), found.alias("found"))

    more = F.array_sort(F.array_except(keys, expected))
    out = F.when(v.isNull(), why(F.lit(None).cast("string"), "object", F.lit("malformed")))
    out = out.when(keys.isNull(), why(F.lit(None).cast("string"), "object", F.schema_of_variant(v)))
    out = out.when(F.size(more) > 0, why(F.element_at(more, 1), "no such key", F.lit("a value")))
    for f in schema.fields:
        out = out.when(_field_bad(v, f), why(F.lit(f.name), f.dataType.simpleString(), F.schema_of_variant(F.variant_get(v, f"$.{f.name}", "variant"))))
    return out


def typed_columns(schema: T.StructType) -> list[Column]:
    out = []
    for f in schema.fields:
        path = f"$.{f.name}"
        if isinstance(f.dataType, T.VariantType):
            c = F.variant_get(F.col("v"), path, "variant")
            c = F.when(F.schema_of_variant(c) == "VOID", None).otherwise(c)
        elif isinstance(f.dataType, T.StringType):
            c = F.try_variant_get(F.col("v"), path, "string")
        else:
            c = F.try_variant_get(F.col("v"), path, f.dataType.simpleString())
        out.append(c.alias(f.name))
    return out


def load_report(checked: DataFrame, *extra: str) -> DataFrame:
    """SNK-3: one row per file (file_path, file_name, extra columns of the file, n_rows, n_bad, reason, status).

    ``reason`` (key, expected and found type) is one refusal's, the least one; of any number of bad lines a file's row holds one.
    """
    # Counted by reason first: the least of structs would sort every line, few rows are left for it here.
    counted = checked.groupBy("file_path", "file_name", *extra, "is_bad", "reason").agg(F.count(F.lit(1)).alias("n"))
    return (counted.groupBy("file_path", "file_name", *extra)
            .agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("is_bad"), F.col("n")).otherwise(0)).alias("n_bad"), F.min("reason").alias("reason"))
            .withColumn("status", F.when(F.col("n_bad") == 0, "loaded").otherwise("failed")))


def failed_files(checked: DataFrame, report: DataFrame) -> DataFrame:
    """The lines of files that did not fail: an anti join with the failed files only.

    That list is usually empty or short, so Spark broadcasts it by its size and no line
    is shuffled; with a long one both sides are plain scans, which lets Spark split a file with many lines.
    """
    return checked.join(report.where("status = 'failed'").select("file_path"), "file_path", "left_anti")


def empty_files(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Report rows of files without a line (names and lengths only; no content is read)."""
    src = path if day is None else f"{path.rstrip('/')}/{DAY_COL}={day_text(day)}"
    columns = f"file_path string, file_name string, n_rows bigint, n_bad bigint, reason {REASON}, status string"
    if not path_exists(spark, src):
        return spark.createDataFrame([], columns)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(src)
             .where("length = 0").select("path"))
    return files.select(F.col("path").alias("file_path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                        F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_bad"), F.lit(None).cast(REASON).alias("reason"), F.lit("loaded").alias("status"))


def strict_rows(checked: DataFrame, report: DataFrame, schema: T.StructType) -> DataFrame:
    return failed_files(checked, report).select(*typed_columns(schema))


def strict_load(spark: SparkSession, path: str, schema: T.StructType, table_path: str | None = None,
                day: str | None = None, fail_fast: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read a landing folder (optionally one day), check, append good files.

    Returns ``(rows, report)``. The report is written first, as a table
    (``<table_path>_load_report``, or a staged one without ``table_path``);
    the rows are then read with its failed files left out, so nothing is
    held on executors between the two passes. With ``table_path`` the rows
    are appended there (SNK-2; a re-run appends again, as the append-only
    log does).
    """
    checked = line_checks(read_lines(spark, path, day), schema).select("file_path", "file_name", "v", "is_bad", "reason")
    load_id = uuid.uuid4().hex
    report_path = f"{table_path.rstrip('/')}_load_report" if table_path else work_dir(spark, "load-report")
    reported = load_report(checked).unionByName(empty_files(spark, path, day))
    reported.withColumn("load_id", F.lit(load_id)).write.mode("append").parquet(report_path)
    report = spark.read.parquet(report_path).where(F.col("load_id") == load_id).drop("load_id")
    if fail_fast:
        failed = report.where("status = 'failed'").select("file_name", "reason").limit(1).collect()
        if failed:
            raise LoadError(f"strict load failed on {failed[0].file_name}: {failed[0].reason}")
    rows = strict_rows(checked, report, schema)
    if table_path:
        append(rows, table_path)
    return rows, report


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A table's rows as the manifest of the warehouse counts them: loads of several tables are seen all at once."""
    if not manifest.managed(spark, base, table):
        return spark.read.parquet(f"{base.rstrip('/')}/{table}")
    names = [f"{base.rstrip('/')}/{table}/{r.file}" for r in manifest.current(spark, base, table).collect()]     # Spark's own file index holds as many
    return spark.read.parquet(*names)


def append(df: DataFrame, table_path: str) -> None:
    """SNK-2 / SET-1: append-only table; every load is a union-all with the past."""
    df.write.mode("append").parquet(table_path)
