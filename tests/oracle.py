"""Run a registered query and its oracle SQL, and compare the two results."""

from __future__ import annotations

import math
import os

import duckdb

DATA = os.environ.get("STRATA_TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    result = con.execute(sql)
    return _sorted_rows([d[0] for d in result.description], result.fetchall())


def in_order(columns, rows, by):
    """Whether the rows come in the order of ``by``: pairs of a column and whether it descends."""
    for column, descending in reversed(by):
        at = columns.index(column)
        rows = sorted(rows, key=lambda r: (r[at] is None, r[at] if r[at] is not None else 0), reverse=descending)
    return rows


def assert_same(df, con, sql):
    columns, rows = spark_rows(df)
    expected_columns, expected = oracle_rows(con, sql)
    assert columns == expected_columns
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        assert got == want
        assert [type(g) for g in got] == [type(w) for w in want], (got, want)
