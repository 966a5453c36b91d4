"""Run every driver query against its DuckDB oracle (row count, columns, values).

Usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelhouse.plans.queries import ORACLE, QUERIES, TABLES  # noqa: E402
from reelhouse.session import local_session  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    if os.environ.get("CHECK_PLAIN"):   # a session with no settings of ours, as a driver may build it
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = local_session()
    if os.environ.get("CHECK_TZ"):   # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["CHECK_TZ"])
    for kv in filter(None, os.environ.get("CHECK_CONF", "").split(",")):   # e.g. spark.sql.ansi.enabled=false
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duckdb.connect()
    for tname in TABLES:
        con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{sf}/{tname}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            s, scols = rows_of(df.columns, srows)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS {name}: {len(srows)} rows ({dt:.1f}s)")
            continue
        try:
            res = con.execute(ORACLE[name])
            ocols = [c[0] for c in res.description]
            o, ocols_sorted = rows_of(ocols, res.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {e}")
            bad += 1
            continue
        ok = s == o and scols == ocols_sorted
        if not ok:
            bad += 1
            print(f"FAIL {name}: spark {len(s)} rows {scols} vs oracle {len(o)} rows {ocols_sorted}")
            diff_s = [r for r in s[:20000] if r not in set(o)][:3]
            diff_o = [r for r in o[:20000] if r not in set(s)][:3]
            print("   spark-only:", diff_s)
            print("   oracle-only:", diff_o)
        else:
            print(f"OK   {name}: {len(s)} rows ({dt:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
