"""Run a registered query and its SQL on the same tables and compare them."""

import glob
import os
import sys
import time
from decimal import Decimal

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float)):
        return ("number", repr(float(value)) if isinstance(value, float) else repr(value))
    if isinstance(value, (list, tuple)):
        return ("list", repr(value))
    return (type(value).__name__, repr(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(df, result):
    """Columns whose types differ between Spark and the SQL."""
    theirs = {c[0]: str(c[1]) for c in result.description}
    return {n: (t, theirs[n]) for n, t in df.dtypes if _TYPES.get(t, t) != theirs.get(n)}


def compare(spark, con, name, function, sql, folder):
    """None when equal, else what differs."""
    started = time.time()
    df = function(spark, folder)
    got = df.collect()
    seconds = time.time() - started
    if sql is None:
        return None, len(got), seconds
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} != {columns}", len(got), seconds
    types = type_differences(df, result)
    if types:
        return f"types {types}", len(got), seconds
    a, b = _rows(df.columns, got), _rows(columns, expected)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}", len(got), seconds
    for x, y in zip(a, b):
        if x != y:
            return f"{x} != {y}", len(got), seconds
    return None, len(got), seconds


def main(names, folder=os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")):
    from starloom.session import build_session
    from starloom.slate import load_all

    spark = build_session("check", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = load_all()
    con = connect(folder)
    bad = []
    for name, function in queries.items():
        if names and name not in names:
            continue
        try:
            problem, rows, seconds = compare(spark, con, name, function, oracles.get(name), folder)
        except Exception as error:  # noqa: BLE001
            problem, rows, seconds = f"{type(error).__name__}: {str(error)[:700]}", -1, 0
        if problem:
            bad.append(name)
        mark = "ok  " if not problem else "FAIL"
        print(f"{mark} {name:28s} {rows:7d} rows {seconds:6.2f}s {'' if name in oracles else '(no sql)'} {problem or ''}", flush=True)
    print(len(bad), "failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
