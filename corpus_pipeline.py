"""The corpus pipeline: language, near-duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next. Null and empty texts have no language and go with the first stage;
rows with repeated ids are one document; columns besides those of ``documents`` are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bpe, chunks, decontaminate, language, near_duplicates
from strata.llm.blocks import table_path
from strata.llm.shipping import shipped
from strata.workspace import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; learned from the labelled rows of ``docs``."""
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.learn_dictionaries(docs), keep=COLUMNS)
    return found.where("NOT rejected").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    found = near_duplicates.near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    kept = docs.select(*COLUMNS).join(found, F.col("doc_id") == F.col("gone"), "left_anti")
    named = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return named.unionByName(kept.where("doc_id IS NULL"))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has already."""
    found = chunks.deduplicate(docs.select(*COLUMNS))
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(table_path(sf_dir, "benchmark"))
    return decontaminate.find_leaks(docs.select(*COLUMNS), benchmark).where("size(leaks) = 0").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each document's tokens, and a digest of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", shipped(identify_language)),
    ("near_duplicates", shipped(drop_near_duplicates)),
    ("substring_dedup", shipped(remove_repeats)),
    ("decontaminate", shipped(drop_leaks)),
    ("bpe", shipped(tokenize)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
