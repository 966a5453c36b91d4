"""Column expressions used inside the jobs (all JVM-side, no Python UDF).

Names follow what they compute; each is a plain ``Column -> Column``
function so Catalyst folds it into the surrounding whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookups import WATCH_URL_PREFIX


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# FN-1 / FN-2 / FN-3: date text -------------------------------------------------
def slash_date(c: Column | str) -> Column:
    """Unpadded ``Y/M/D`` (2023/6/4)."""
    return F.date_format(col_(c), "y/M/d")


def dash_date(c: Column | str) -> Column:
    """Unpadded ``Y-M-D`` (2023-6-4): the landing folder value."""
    return F.date_format(col_(c), "y-M-d")


def padded_date(c: Column | str) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def padded_datetime(c: Column | str) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss")


# FN-4: epoch seconds as float ----------------------------------------------------
def epoch_seconds(run_ts: float | None = None) -> Column:
    """Time of the run in epoch seconds (DOUBLE).

    One value per query (Spark folds ``current_timestamp`` once), instead of
    one clock read per record. Pass ``run_ts`` to pin it (tests, re-runs).
    """
    if run_ts is not None:
        return F.lit(float(run_ts)).cast("double")
    return (F.unix_micros(F.current_timestamp()) / F.lit(1_000_000.0)).cast("double")


# FN-5: base name / directory name, with os.path semantics -------------------------
def base_name(c: Column | str) -> Column:
    return F.regexp_extract(col_(c), r"([^/]*)$", 1)


def dir_name(c: Column | str) -> Column:
    """``os.path.dirname``: head up to the last '/', trailing slashes removed
    unless the head is made of slashes only ('/a' -> '/', 'a' -> '')."""
    head = F.regexp_extract(col_(c), r"^(.*/)", 1)
    stripped = F.regexp_replace(head, r"/+$", "")
    return F.when(head == "", F.lit("")).when(stripped == "", head).otherwise(stripped)


def extension(c: Column | str) -> Column:
    """Lower-case extension of the base name ('' when none)."""
    return F.lower(F.regexp_extract(base_name(c), r"\.([^.]*)$", 1))


# FN-7: url from id ------------------------------------------------------------------
def watch_url(video_id: Column | str) -> Column:
    return F.concat(F.lit(WATCH_URL_PREFIX), col_(video_id))


# FN-10: JSON encode keeping nulls -------------------------------------------------
# Nulls kept and non-ASCII written as \u escapes, as a default JSON encoder does.
JSON_KEEP_NULLS = {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}


def to_json_keep_nulls(c: Column) -> Column:
    return F.to_json(c, JSON_KEEP_NULLS)


# FN-11: JSON text -> VARIANT -----------------------------------------------------------
def json_variant(c: Column | str) -> Column:
    """Parse JSON text to VARIANT; malformed text gives null (not an error)."""
    return F.try_parse_json(col_(c))


# FN-15: ISO time n days ahead, milliseconds and 'Z' ----------------------------------
def iso_in_days(ts: Column | str, days: int = 10) -> Column:
    ahead = col_(ts) + F.expr(f"INTERVAL {int(days)} DAYS")
    return F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# FN-16: Python truth value of one cell, by type ------------------------------------
def truthy(c: Column | str, dtype: T.DataType) -> Column:
    """``bool(value)`` as Python computes it for the fetched cell.

    Numbers and intervals: non-zero; strings / binary / arrays / maps: non-empty;
    booleans: themselves; null: false. No SQL cast: ``bool('0')`` is True
    while ``CAST('0' AS BOOLEAN)`` is false.
    """
    x = col_(c)
    if isinstance(dtype, T.BooleanType):
        out = x
    elif isinstance(dtype, T.NumericType):
        out = x != 0
    elif isinstance(dtype, T.DayTimeIntervalType):
        out = x != F.expr("INTERVAL '0' SECOND")
    elif isinstance(dtype, T.YearMonthIntervalType):
        out = x != F.expr("INTERVAL '0' MONTH")
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        out = F.length(x) > 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        out = F.size(x) > 0
    else:  # dates, timestamps, structs: any present value is truthy
        out = x.isNotNull()
    return F.coalesce(out, F.lit(False))


# FN-17: file stem ------------------------------------------------------------------------
def csv_stem(c: Column | str) -> Column:
    return F.regexp_replace(col_(c), r"\.csv$", "")


# FN-18 / FLT-8 / FLT-9: parity tests ---------------------------------------------------
def is_even_minute(ts: Column | str) -> Column:
    return F.minute(col_(ts)) % 2 == 0


def is_odd(n: Column | str) -> Column:
    """True for odd numbers, negatives included (Spark's -3 % 2 is -1)."""
    return col_(n) % 2 != 0


# LIM-2 / FN-8: null-safe element access ---------------------------------------------------
def nth(arr: Column | str, i: int) -> Column:
    """0-based element, null when out of range (``arr[i]`` raises under ANSI)."""
    return F.get(col_(arr), F.lit(i))
