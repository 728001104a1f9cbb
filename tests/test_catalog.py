"""Every registered query against its oracle, on whole tables."""

import pytest

import __spark_entry__ as entry
from strata.catalog import QUERIES
from oracle import DATA, assert_same, connect, in_order

# The optional queries have tests of their own, beside them.
SQL = {name: sql for name, (_, sql) in QUERIES.items()}


@pytest.fixture(scope="module")
def oracle():
    return connect(f"{DATA}/sf0.01")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, oracle, name):
    assert_same(entry.queries()[name](spark, f"{DATA}/sf0.01"), oracle, SQL[name])


ORDERED = {
    "top_per_capita_latest": [("gdp_per_capita_juta", True)],
    "band_averages": [("avg_gdp_miliar", True)],
    "yoy_growth": [("province_name", False), ("year", False)],
    "national_trend": [("year", False)],
    "sql_views": [("year", False)],
    "density_topk": [("population_density", True)],
    "graph_wide_row": [("iso_code", False)],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_the_order_of_sorted_results(spark, name):
    df = entry.queries()[name](spark, f"{DATA}/sf0.01")
    rows = [tuple(r) for r in df.collect()]
    for column, descending in ORDERED[name][:1]:
        at = df.columns.index(column)
        values = [r[at] for r in rows]
        known = [v for v in values if v is not None]
        assert known == sorted(known, reverse=descending)
        # missing codes first, elsewhere missing figures last
        nulls = len(values) - len(known)
        assert all(v is None for v in (values[:nulls] if name == "graph_wide_row" else values[len(known):]))
    if len(ORDERED[name]) > 1:
        assert rows == in_order(df.columns, rows, ORDERED[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
