"""Runs a registered query and its SQL twin on the same tables and compares the rows.

As a script: python tests/compare.py <sf_dir> [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from ticketlens.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return "null" if value is None else str(value)


def table_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_side(df):
    return sorted(df.columns), table_rows(df.columns, df.collect())


def sql_side(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), table_rows(columns, result.fetchall())


def main() -> None:
    import __spark_entry__ as entry
    from ticketlens.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            columns, rows = spark_side(build(spark, sf_dir))
            took = time.time() - started
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"rows {name}: {len(rows)} rows {took:.1f}s")
                continue
            sql_columns, sql_rows = sql_side(con, sql)
            if columns == sql_columns and rows == sql_rows:
                print(f"ok   {name}: {len(rows)} rows {took:.1f}s")
                continue
            bad += 1
            off = next((p for p in zip(rows, sql_rows) if p[0] != p[1]), None)
            print(f"DIFF {name}: {columns} vs {sql_columns}; {len(rows)} vs {len(sql_rows)} rows; first {off}")
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: {str(error)[:1500]}")
    print("failures:", bad)


if __name__ == "__main__":
    main()
