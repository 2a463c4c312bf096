"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

``python -m checks.compare [folder] [name …]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks import all_queries
from checks.inputs import BASE
from checks.registry import ORACLES, QUERIES, Data


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "∅" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, int):
        return str(v)
    return str(v)


def table(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def run_one(spark: SparkSession, con, folder: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](Data(spark, folder))
    got = table(df.columns, df.collect())
    took = time.time() - start
    if name not in ORACLES:
        return len(got) > 0, f"rows only: {len(got)} rows, {took:.1f}s"
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    want = table(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        missing = sorted(set(want) - set(got))[:2]
        extra = sorted(set(got) - set(want))[:2]
        return False, f"{len(got)} rows != {len(want)} rows; columns {sorted(columns)}; missing {missing}; extra {extra}"
    return len(got) > 0, f"{len(got)} rows, {took:.1f}s"


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    from itinera.session import local_session

    all_queries()
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        try:
            ok, note = run_one(spark, con, folder, name)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{bad} failed of {len(names or QUERIES)}; {len(ORACLES)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
