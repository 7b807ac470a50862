"""Run registered queries next to their SQL in DuckDB and compare the values.

    python tests/check_queries.py [--sf 0.01] [name …]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else float(f"{number:.9g}")
    return value


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [names[i] for i in order]


# Spark type → DuckDB type; both sides should agree, not only in value.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = queries()[name](spark, folder)
    got, names = bag(df.collect(), df.columns)
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {c: TYPES.get(t, t) for c, t in df.dtypes}
    if mine != theirs:
        return f"types {mine} != {theirs}"
    cursor = con.execute(sql)
    want_names = [c[0] for c in cursor.description]
    want, want_names = bag(cursor.fetchall(), want_names)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} != {theirs}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--dir", help="a folder of tables, instead of --sf")
    parser.add_argument("--zone", default="UTC", help="session time zone")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from docsheaf import build_session
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": args.zone})
    spark.sparkContext.setLogLevel("ERROR")
    folder = args.dir or f"/root/testdata/sf{args.sf}"
    con = connect(folder)
    bad = 0
    for name in args.names or queries():
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report every query, not only the first
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(args.names or queries())} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
