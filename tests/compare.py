"""Run registered queries next to their DuckDB SQL and compare the full results.

Usage: python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from datetime import date, datetime

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime):
        v = v.date() if v.time() == datetime.min.time() else v
    return v.isoformat() if isinstance(v, date) else str(v)


def table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    rows = df.collect()
    return sorted(df.columns), table(df.columns, rows)


def duck_result(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), table(columns, cur.fetchall())



def spark_types(df) -> dict[str, str]:
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN"}
    return {n: names.get(t, t) for n, t in df.dtypes}


def duck_types(con, sql: str) -> dict[str, str]:
    return {c[0]: str(c[1]) for c in con.execute(sql).description}


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="weekloom-compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), e.oracle_sql(), 0
    for name in names:
        t = time.time()
        try:
            df = e.queries()[name](spark, folder)
            cols, got = spark_result(df)
            took = time.time() - t
            if name not in sqls:
                print(f"rows  {name} {len(got)} {took:.2f}s", flush=True)
                continue
            want_cols, want = duck_result(con, sqls[name])
            types, want_types = spark_types(df), duck_types(con, sqls[name])
            diff = [(k, types.get(k), want_types.get(k)) for k in want_types if types.get(k) != want_types[k]]
            ok = cols == want_cols and got == want and not diff
            print(f"{'ok   ' if ok else 'FAIL '} {name} {len(got)} {took:.2f}s", flush=True)
            if not ok:
                bad += 1
                print("   columns", cols, want_cols, "types", diff, "rows", len(got), len(want))
                odd = [(a, b) for a, b in zip(got, want) if a != b][:3]
                for a, b in odd:
                    print("   spark", a, "\n   duck ", b)
        except Exception as err:
            bad += 1
            print(f"ERROR {name}: {str(err)[:900]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
