"""Run query keys in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from millrace.session import TABLE_NAMES  # noqa: E402


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(plain(r[i])) for i in order) for r in data)


def spark_rows(df):
    return df.columns, rows(df.columns, df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, rows(names, cur.fetchall())


def differences(spark, folder, con, plan, sql):
    """None when both sides agree, else a short text."""
    got_names, got = spark_rows(plan(spark, folder))
    if sql is None:
        return None if got else "no rows"
    want_names, want = duck_rows(con, sql)
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; "
            f"only spark {list(extra)[:3]}; only sql {list(missing)[:3]}"
        )
    return None if want else "no rows"


if __name__ == "__main__":
    from millrace import build_session
    from millrace.plans import CHECKS, QUERIES

    folder = f"/root/testdata/sf{sys.argv[1]}"
    keys = sys.argv[2:] or list(QUERIES)
    session = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            problem = differences(session, folder, con, QUERIES[key], CHECKS.get(key))
        except Exception as error:  # report and go on to the next key
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {key} {time.time() - start:.2f}s {'' if key in CHECKS else '[rows]'} {problem or ''}", flush=True)
    print(f"{len(keys)} keys, {bad} bad")
