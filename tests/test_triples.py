"""Triples stored by predicate and subject: same results, fewer exchanges, hot subjects apart."""

import pytest
from pyspark.sql import functions as F

from strata.lake.triples import _table_name, open_triples, stored_optionals, write_triples
from strata.operators.graph import optionals

SCHEMA = "s string, p string, o string, lang string"
WANTED = {"name": ("label", "en"), "code": ("code", None), "part": ("x:part", None)}
ROWS = [
    *((f"n{i}", "label", f"name {i}", "en") for i in range(40) if i % 3),
    *((f"n{i}", "label", f"nom {i}", "fr") for i in range(40)),
    *((f"n{i}", "code", str(i), None) for i in range(40) if i % 4),
    *(("n7", "x:part", f"part {i % 20}", None) for i in range(50)),  # hot, with repeated triples
    ("n8", "x:part", "one", None), ("n8", "x:part", None, None),
    (None, "code", "no subject", None), ("n9", None, "no predicate", None),
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("graph") / "store")
    triples = spark.createDataFrame(ROWS, SCHEMA)
    return path, triples, write_triples(triples, path, buckets=4, hot_rows=20)


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def test_every_triple_is_stored_once_and_hot_subjects_apart(stored):
    _, triples, store = stored
    assert rows(store.triples()) == rows(triples)
    assert [r["s"] for r in store.hot_subjects.collect()] == ["n7"]
    assert {r["s"] for r in store.hot.collect()} == {"n7", None}


def test_patterns_equal_those_over_the_plain_table(spark, stored):
    _, triples, store = stored
    subjects = spark.createDataFrame([(f"n{i}",) for i in range(45)], "s string")  # five without any triple
    found = stored_optionals(subjects, store, WANTED)
    assert rows(found) == rows(optionals(subjects, triples, WANTED))
    assert found.filter("s = 'n7'").count() == 50


@pytest.mark.parametrize("partitions", [2, 4, 16])
def test_no_triple_of_a_bucketed_subject_is_shuffled(spark, stored, partitions):
    _, _, store = stored
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        subjects = spark.range(45).select(F.concat(F.lit("n"), "id").alias("s"))
        plan = stored_optionals(subjects, store, WANTED)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    bucketed = plan[plan.index("Union"):].split("\n   :- ", 1)[1].split("\n   +- ", 1)[0]
    assert bucketed.count("Bucketed: true") == len(WANTED)
    # the subjects meet the hot ones, then go to the buckets
    assert bucketed.count("Exchange") <= 3
    for line, after in zip(bucketed.splitlines(), bucketed.splitlines()[1:]):
        assert not ("Exchange" in line and "strata_triples_" in after)


def test_a_session_that_does_not_know_the_table_opens_it(spark, stored):
    path, triples, _ = stored
    spark.sql(f"DROP TABLE {_table_name(path)}")
    assert rows(open_triples(spark, path).triples()) == rows(triples)


def test_only_committed_stores_are_opened(spark, stored, tmp_path):
    path, triples, _ = stored
    with pytest.raises(FileNotFoundError):
        open_triples(spark, str(tmp_path / "none"))
    with pytest.raises(FileExistsError):
        write_triples(triples, path, buckets=4)


def test_an_empty_table(spark, tmp_path):
    store = write_triples(spark.createDataFrame([], SCHEMA), str(tmp_path / "empty"), buckets=2)
    assert store.triples().count() == 0
    subjects = spark.createDataFrame([("a",)], "s string")
    assert [tuple(r) for r in stored_optionals(subjects, store, WANTED).collect()] == [("a", None, None, None)]
