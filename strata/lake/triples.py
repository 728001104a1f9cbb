"""Triples stored by predicate and subject, so that patterns of one subject join without a shuffle.

Triples ``s, p, o, lang`` have a folder a predicate and in each the same buckets of ``s``. A scan of one
predicate is dealt by subject already, so is any other, and Spark joins them bucket by bucket. Spark
cannot split a bucket, so subjects with more than ``hot_rows`` triples are stored apart, by
predicate only. Their joins are shuffled, and there the skew join can split them. A
bucket's size follows from the triples over the number of buckets, which is a parameter.

``layout.json`` is written last and commits a store: a folder without one is not opened. Rows without a subject
match no pattern; they are stored with the hot ones. Repeated triples stay. An empty table is stored as one.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.graph import optionals, pattern
from strata.sources.objects import read_text, write_text

COLUMNS = ("s", "o", "lang", "p")


@dataclass(frozen=True)
class TripleStore:
    """A stored triples table."""

    bucketed: DataFrame
    hot: DataFrame
    hot_subjects: DataFrame
    buckets: int

    def triples(self) -> DataFrame:
        """All triples, for patterns that do not start from the subject."""
        return self.bucketed.unionByName(self.hot)


def _table_name(path: str) -> str:
    return f"strata_triples_{hashlib.md5(path.encode()).hexdigest()}"


def write_triples(triples: DataFrame, path: str, buckets: int, hot_rows: int = 10_000_000) -> TripleStore:
    """Store ``triples`` in a new folder and open it.

    They are read three times, so they must be the same each time: stored ones, or a fixed source.
    """
    spark = triples.sparkSession
    path = path.rstrip("/")
    if read_text(spark, f"{path}/layout.json") is not None:
        raise FileExistsError(f"{path} is a triple store already")
    rows = triples.select(*(F.col(c).cast("string").alias(c) for c in COLUMNS))
    counted = rows.filter(F.col("s").isNotNull()).groupBy("s").count()
    counted.filter(F.col("count") > hot_rows).select("s").write.mode("overwrite").parquet(f"{path}/hot_subjects")
    hot_subjects = spark.read.schema("s string").parquet(f"{path}/hot_subjects")
    hot = rows.join(hot_subjects, "s", "left_semi").unionByName(rows.filter(F.col("s").isNull()))
    # a predicate's rows are dealt with others of it, and a frequent one is cut
    hot.hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(f"{path}/hot")
    cold = rows.filter(F.col("s").isNotNull()).join(hot_subjects, "s", "left_anti").select(*COLUMNS)
    # dealt as the buckets are, so that each is one sorted file a predicate
    cold.repartition(buckets, "s").write.mode("overwrite").partitionBy("p").bucketBy(buckets, "s").sortBy("s").option(
        "path", f"{path}/bucketed").saveAsTable(_table_name(path))
    write_text(spark, f"{path}/layout.json", json.dumps({"buckets": buckets, "hot_rows": hot_rows}), exclusive=True)
    return open_triples(spark, path)


def open_triples(spark: SparkSession, path: str) -> TripleStore:
    """The store in a folder; a session that does not know its table yet is told of it."""
    path = path.rstrip("/")
    layout = read_text(spark, f"{path}/layout.json")
    if layout is None:
        raise FileNotFoundError(f"no triple store in {path}")
    name, buckets = _table_name(path), json.loads(layout)["buckets"]
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} (s STRING, o STRING, lang STRING, p STRING) USING parquet "
            f"OPTIONS (path '{path}/bucketed') PARTITIONED BY (p) CLUSTERED BY (s) SORTED BY (s) INTO {buckets} BUCKETS")
        spark.catalog.recoverPartitions(name)
    hot = spark.read.schema("s string, o string, lang string, p string").parquet(f"{path}/hot")
    return TripleStore(spark.table(name), hot, spark.read.schema("s string").parquet(f"{path}/hot_subjects"), buckets)


def stored_optionals(subjects: DataFrame, store: TripleStore, wanted: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Optional patterns of distinct ``subjects`` over a store, with the results of ``optionals``.

    Only ``subjects`` are shuffled, to where the buckets are; every predicate is joined there. A bucketed
    subject has no more than ``hot_rows`` triples, so plain left joins hold. Hot ones go through
    ``optionals`` over their own triples.
    """
    named = subjects.select("s")
    # dealt as the buckets are at any number of shuffle partitions, else Spark would deal the triples instead
    rows = named.join(store.hot_subjects, "s", "left_anti").repartition(store.buckets, "s")
    for out, (predicate, lang) in wanted.items():
        rows = rows.join(pattern(store.bucketed, predicate, out, lang), "s", "left")
    return rows.unionByName(optionals(named.join(store.hot_subjects, "s", "left_semi"), store.hot, wanted))
