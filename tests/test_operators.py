"""Operators against brute force, and unchanged by the distribution of rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import joins as J
from strata.operators.graph import best_label, complete, latest_statement, optionals, point_latitude, point_longitude
from strata.operators.keys import dense_key
from strata.operators.reshape import distinct_values, pivot_mean


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cells, expected", [
    (["3403166.85", None, "2"], [3403166.85, None, 2.0]),
    (["1.234.567,8", "5"], [1234567.8, 5.0]),
    (["1.234.567", "3403166.85"], [1234567.0, 340316685.0]),
    ([None, None], [None, None]),
    (["x", "1.5"], [None, 15.0]),
])
def test_number_format_is_decided_per_column(spark, cells, expected):
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string")
    parsed = C.locale_numbers(df, ["v", "absent"]).orderBy("i").collect()
    assert [r["v"] for r in parsed] == expected


def test_number_format_can_be_named(spark):
    df = spark.createDataFrame([("1.234",)], "v string")
    assert C.locale_numbers(df, ["v"], "plain").first()[0] == 1.234
    assert C.locale_numbers(df, ["v"], "grouped").first()[0] == 1234.0
    with pytest.raises(ValueError):
        C.locale_numbers(df, ["v"], "other")


def test_clean_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(1, " NA", 2.0), (2, " x", None)], "a int, b string, c double")
    assert rows_of(C.clean_strings(df)) == [(1, None, 2.0), (2, "x", None)]


def events(n, seed=1):
    """Half of the rows share one key, and some keys are null."""
    rng = random.Random(seed)
    return [(rng.choice([None, "hot", "hot", "a", "b"]), rng.randrange(50), i) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first(spark, parts):
    rows = events(500)
    df = spark.createDataFrame(rows, "k string, t int, i int").repartition(parts)
    frame = pd.DataFrame(rows, columns=["k", "t", "i"]).sort_values(["t", "i"]).drop_duplicates("k")
    kept = C.keep_first(df, ["k"], [F.col("t"), F.col("i")])
    assert {(r.k, r.i) for r in kept.collect()} == set(zip(frame.k, frame.i))


@pytest.mark.parametrize("parts", [1, 7])
def test_latest_with_ties(spark, parts):
    rows = [(k or "none", None if t == 7 else t, i) for k, t, i in events(500)]
    df = spark.createDataFrame(rows, "k string, t int, i int").repartition(parts)
    best = {k: max(t for q, t, _ in rows if q == k and t is not None) for k, _, _ in rows}
    assert rows_of(C.latest_with_ties(df, "k", "t")) == sorted(((k, t, i) for k, t, i in rows if t == best[k]), key=repr)


def test_outer_merge_matches_a_null_safe_full_join(spark):
    left = [("a", 1, 10.0), ("a", 1, 11.0), ("a", 2, 12.0), (None, 1, 13.0), ("b", None, 14.0), ("c", 3, 15.0)]
    right = [("a", 1, 100), ("a", 1, 101), (None, 1, 102), ("b", None, 103), ("d", 4, 104), ("a", 5, 105)]
    a = spark.createDataFrame(left, "k string, y int, x double")
    b = spark.createDataFrame(right, "k string, y int, z int")
    keys = {(l[0], l[1]) for l in left}, {(r[0], r[1]) for r in right}
    expected = [(l[0], l[1], l[2], r[2]) for l in left for r in right if l[:2] == r[:2]]
    expected += [(*l, None) for l in left if l[:2] not in keys[1]]
    expected += [(r[0], r[1], None, r[2]) for r in right if r[:2] not in keys[0]]
    assert rows_of(J.outer_merge(a, b, ["k", "y"])) == sorted(expected, key=repr)


def test_outer_merge_of_one_table_with_itself(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    other = df.filter("v > 1").withColumnRenamed("v", "w")
    assert rows_of(J.outer_merge(df, other, ["k"])) == [("a", 1, None), ("b", 2, 2)]


def test_alias_priority(spark):
    dim = spark.createDataFrame([(1, "yogyakarta", "x"), (2, "daerah istimewa yogyakarta", "special region of yogyakarta"),
                                 (3, "jakarta", "jakarta"), (4, None, "aceh"), (5, "aceh", None)],
                                "id bigint, local string, english string")
    lookup = J.alias_lookup(dim, "id", ["local", "english"])
    names = [" DI Yogyakarta", "Yogyakarta", "DKI JAKARTA", "Nanggroe Aceh Darussalam", "Aceh", "Atlantis", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.id for r in J.resolve_names(df, lookup, "name", "id").collect()}
    assert got == {" DI Yogyakarta": 2, "Yogyakarta": 1, "DKI JAKARTA": 3, "Nanggroe Aceh Darussalam": 4, "Aceh": 4,
                   "Atlantis": None, None: None}
    assert [r.name for r in J.unmatched(df, lookup, "name").collect()] == ["Atlantis"]


def test_semi_and_label_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, c string")
    codes = spark.createDataFrame([("a", "A"), ("a", "AA")], "c string, label string")
    assert rows_of(J.member_rows(df, codes, "c")) == [("a", 1)]
    assert rows_of(J.label_lookup(df, codes, "c")) == [("a", 1, "A"), ("a", 1, "AA")]


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_key_over_many_partitions(spark, parts):
    rows = [(k, t, i) for k, t, i in events(400, seed=3)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k string, t int, i int").repartition(parts)
        keyed = dense_key(df, "id", ["k", "t", "i"])
        got = [(r.k, r.t, r.i) for r in sorted(keyed.collect(), key=lambda r: r.id)]
        assert sorted(r.id for r in keyed.collect()) == list(range(1, 401))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], r[2]))


def test_dense_key_spreads_equal_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit("same").alias("v")).repartition(8)
        keyed = dense_key(df, "id", ["v"])
        assert keyed.agg(F.count_distinct("id"), F.min("id"), F.max("id")).first() == (4000, 1, 4000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pivot_mean(spark):
    df = spark.createDataFrame([("a", "530", 1.0), ("a", "530", 3.0), ("a", "531", None), ("b", "531", None), ("c", "9", 1.0)],
                               "k string, m string, v double")
    wide = pivot_mean(df, ["k"], "m", "v", {"530": "current", "531": "constant"})
    assert wide.columns == ["k", "current", "constant"]
    assert rows_of(wide) == [("a", 2.0, None)]


def test_distinct_values(spark):
    a = spark.createDataFrame([(1,), (None,), (2,), (2,)], "year int")
    b = spark.createDataFrame([(2,), (5,)], "year int")
    assert rows_of(distinct_values("year", a, spark.range(3), b)) == [(1,), (2,), (5,)]
    with pytest.raises(ValueError):
        distinct_values("year", spark.range(3))


TRIPLES = [
    ("e1", "stmt", "n1", None), ("n1", "val", "10", None), ("n1", "at", "2020", None),
    ("e1", "stmt", "n2", None), ("n2", "val", "11", None), ("n2", "at", "2021", None),
    ("e1", "stmt", "n3", None), ("n3", "val", "12", None), ("n3", "at", "2021", None),
    ("e1", "stmt", "n4", None), ("n4", "val", "13", None),
    ("e2", "stmt", "n5", None), ("n5", "val", "14", None),
    ("e3", "stmt", "n6", None), ("n6", "val", "15", None), ("n6", "at", "2019", None),
    ("e3", "stmt", "n7", None), ("n7", "at", "2022", None),
    ("c1", "label", "Satu", "id"), ("c1", "label", "One", "en"), ("c2", "label", "Two", "en"), ("c3", "label", "Drei", "de"),
    ("e1", "capital", "c1", None), ("e2", "capital", "c2", None), ("e2", "capital", "c3", None),
]


def test_graph_patterns(spark):
    triples = spark.createDataFrame(TRIPLES, "s string, p string, o string, lang string")
    latest = latest_statement(triples, "stmt", "val", "at", "pop", "at")
    assert rows_of(latest) == [("e1", "11", "2021"), ("e1", "12", "2021")]
    entities = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "s string")
    rows = optionals(entities, triples, {"capital": ("capital", None)})
    named = best_label(rows, triples, "capital", "name", F.col("capital"), "label", ["id", "en"])
    assert rows_of(named) == [("e1", "c1", "Satu"), ("e2", "c2", "Two"), ("e2", "c3", "c3"), ("e3", None, None)]
    places = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "s string")
    labels = optionals(places, triples, {"id_label": ("label", "id"), "any": ("label", None)})
    assert rows_of(labels) == [("c1", "Satu", "One"), ("c1", "Satu", "Satu"), ("c2", None, "Two"), ("c3", None, "Drei")]
    assert rows_of(complete(places, latest)) == [("c1", None, None), ("c2", None, None), ("c3", None, None)]
    assert rows_of(complete(entities, latest))[2:] == [("e2", None, None), ("e3", None, None)]


def test_points(spark):
    df = spark.createDataFrame([("Point(106.8 -6.2)",), ("nowhere",), (None,)], "w string")
    assert [tuple(r) for r in df.select(point_latitude(F.col("w")), point_longitude(F.col("w"))).collect()] == [
        (-6.2, 106.8), (None, None), (None, None),
    ]
