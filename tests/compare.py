"""Compare a query with its SQL counterpart: columns by name, rows in any order."""

from __future__ import annotations

import glob
import os

import duckdb


def oracle_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), _normal(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _normal(df.columns, [tuple(r) for r in df.collect()])


def _normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)
