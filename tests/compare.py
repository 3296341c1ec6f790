"""Compare a Spark result with its SQL counterpart."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if columns and all rows agree exactly; otherwise what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows_of(names, cur.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(names)} != {sorted(spark_df.columns)}"]
    if len(expected) != len(got):
        return [f"{len(got)} rows, expected {len(expected)}"]
    bad = [f"{g} != {e}" for g, e in zip(got, expected) if not _same(g, e)]
    return bad[:5]


def _same(a: tuple, b: tuple) -> bool:
    return all(type(x) is type(y) and (x == y or _both_nan(x, y)) for x, y in zip(a, b))


def _both_nan(x, y) -> bool:
    return isinstance(x, float) and math.isnan(x) and math.isnan(y)
