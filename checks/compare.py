"""Run registered queries on Spark and their check SQL on DuckDB and compare the rows.

Usage: python -m checks.compare [directory] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from cohortlink.session import build_session

from .oracle import oracle_sql
from .queries import queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in result.fetchall())


def main(directory: str, wanted: list[str]) -> int:
    spark = build_session(master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(directory), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        names, got = spark_rows(run(spark, directory))
        spent = time.time() - start
        if name not in checks:
            print(f"{name:28s} {sum(got.values()):8d} rows  {spent:6.2f}s  no check SQL")
            continue
        expected_names, expected = duck_rows(con, checks[name])
        same = names == expected_names and got == expected
        bad += not same
        print(f"{name:28s} {sum(got.values()):8d} rows  {spent:6.2f}s  {'ok' if same else 'DIFFERS'}", flush=True)
        if not same:
            print("   spark columns", names, "\n   check columns", expected_names)
            print("   only spark", list((got - expected).items())[:3])
            print("   only check", sum(expected.values()), list((expected - got).items())[:3])
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
