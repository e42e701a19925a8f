"""Compare registered queries with their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, decimal.Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v) if isinstance(v, datetime.date) else v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(df) -> Counter:
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, rows_of(names, result.fetchall())


def main() -> int:
    import __spark_entry__ as registered
    from reviewtide.session import local_session

    sf_dir, *wanted = sys.argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = registered.oracle_sql()
    bad = 0
    for name, query in registered.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - started
            names, expected = sql_rows(con, oracle[name])
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        same = sorted(df.columns) == sorted(names) and got == expected
        bad += not same
        print(f"{'ok   ' if same else 'DIFF '} {name} rows={sum(got.values())} {took:.2f}s", flush=True)
        if not same:
            print("   columns", sorted(df.columns), sorted(names), sum(expected.values()))
            print("   spark only", [str(r)[:300] for r in list((got - expected))[:3]])
            print("   sql only  ", [str(r)[:300] for r in list((expected - got))[:3]])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
