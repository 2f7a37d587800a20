"""Order-insensitive comparison of a Spark result with the SQL oracle."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    return names, cursor.fetchall()


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, sql: str, sf_dir: str) -> list[str]:
    names, expected = oracle_rows(sql, sf_dir)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    found = _bag(df.columns, [tuple(row) for row in df.collect()])
    wanted = _bag(names, expected)
    problems = []
    if found != wanted:
        problems.append(f"{found.total()} rows against {wanted.total()}")
        problems += [f"only in Spark: {row}" for row in list((found - wanted))[:3]]
        problems += [f"only in SQL: {row}" for row in list((wanted - found))[:3]]
    return problems
