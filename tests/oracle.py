"""Runs a query's SQL in DuckDB over the same Parquet tables and compares all values."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    r = c.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def _cell(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "null" if v != v else repr(round(v, 9))
    return str(v)


def normal(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(_cell(r[k]) for k in order) for r in rows)


def assert_same(df, sql: str, sf_dir: str) -> int:
    cols, rows = duck(sql, sf_dir)
    assert sorted(df.columns) == sorted(cols)
    mine = df.collect()
    assert normal(df.columns, mine) == normal(cols, rows)
    return len(rows)
