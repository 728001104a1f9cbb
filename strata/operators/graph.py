"""Graph patterns over a triples table ``s, p, o, lang``.

Each pattern filters the predicate first. Store a large triples table partitioned by ``p``: the
filter then prunes folders and every pattern reads only its own predicate. ``strata.lake.triples``
stores it by subject as well, for joins without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import captured
from strata.operators.clean import latest_with_ties
from strata.workspace import materialize

_POINT = r"^\s*[Pp][Oo][Ii][Nn][Tt]\s*\(\s*(\S+)\s+([^\s)]+)\s*\)\s*$"


def pattern(triples: DataFrame, predicate: str, out: str, lang: str | None = None) -> DataFrame:
    """Objects of ``predicate`` as rows ``s, <out>``, of one language if given."""
    rows = triples.filter(F.col("p") == predicate)
    if lang is not None:
        rows = rows.filter(F.col("lang") == lang)
    return rows.select("s", F.col("o").alias(out))


def members(triples: DataFrame, subject: str, predicate: str) -> DataFrame:
    """Required pattern: the objects of one subject become the subjects ``s`` of the result."""
    rows = triples.filter((F.col("s") == subject) & (F.col("p") == predicate))
    return rows.select(F.col("o").alias("s"))


def complete(subjects: DataFrame, values: DataFrame) -> DataFrame:
    """``values`` of the given subjects, and a row of nulls for each subject without any.

    Semi and anti join against reduced sides: a subject with very many values is split.
    """
    found = values.join(subjects, "s", "left_semi")
    bare = subjects.join(values.select("s").distinct(), "s", "left_anti")
    return found.unionByName(bare, allowMissingColumns=True)


def optionals(
    subjects: DataFrame, triples: DataFrame, wanted: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """Optional patterns of distinct ``subjects``: ``wanted`` maps a column to (predicate, language).

    A subject without a value keeps null, several values give several rows. The language is part of
    the pattern, so a subject labelled in other languages only still keeps its row. The wanted
    triples of the subjects are stored first. One aggregate over them tells which subjects lack
    which value. They get a row of null among the values, and every join is an inner one, which
    the skew join can split on both sides; a left join could not split a subject with very many
    values. For a chain of joins the split needs ``spark.sql.adaptive.forceOptimizeSkewedJoin``.
    """
    predicates = sorted({predicate for predicate, _ in wanted.values()})
    named = triples.filter(F.col("p").isin(*predicates)).join(subjects.select("s"), "s", "left_semi")
    triples = materialize(named.select("s", "p", "o", "lang").sortWithinPartitions("p"), "wanted")
    marks = triples.groupBy("s").agg(*[
        F.bool_or((F.col("p") == predicate) & (F.lit(True) if lang is None else F.col("lang").eqNullSafe(lang)))
        .alias(f"_has_{out}")
        for out, (predicate, lang) in wanted.items()
    ])
    marked = materialize(subjects.join(marks, "s", "left").na.fill(False), "marked")
    rows = marked.select("s")
    for out, (predicate, lang) in wanted.items():
        bare = marked.filter(~F.col(f"_has_{out}")).select("s")
        values = pattern(triples, predicate, out, lang).unionByName(bare, allowMissingColumns=True)
        rows = rows.join(values, "s")
    return rows


def point_longitude(point: Column) -> Column:
    """First ordinate of ``Point(lon lat)``; null where the text is no point."""
    return captured(point, _POINT, 1).try_cast("double")


def point_latitude(point: Column) -> Column:
    """Second ordinate of ``Point(lon lat)``; null where the text is no point."""
    return captured(point, _POINT, 2).try_cast("double")


def latest_statement(
    triples: DataFrame, statement: str, value: str, moment: str, out: str, out_moment: str,
    subjects: DataFrame | None = None,
) -> DataFrame:
    """Values of each subject's latest dated statement: ``s, <out>, <out_moment>``.

    Ties are kept. "Latest" is judged over all dated statements: where the latest one carries
    no value, the subject has no row. ``subjects`` limits the statements to theirs. The dated
    statements are stored, as they are read twice.
    """
    nodes = pattern(triples, statement, "_node")
    if subjects is not None:
        nodes = nodes.join(subjects.select("s"), "s", "left_semi")
    moments = pattern(triples, moment, out_moment).withColumnRenamed("s", "_node")
    values = pattern(triples, value, out).withColumnRenamed("s", "_node")
    latest = latest_with_ties(materialize(nodes.join(moments, "_node"), "dated"), "s", out_moment)
    return latest.join(values, "_node").select("s", out, out_moment)


def best_label(rows: DataFrame, triples: DataFrame, on: str, out: str, fallback: Column,
               predicate: str, languages: Sequence[str]) -> DataFrame:
    """Label of the node in ``on`` in the first language that has one, else ``fallback``.

    All languages come from one filtered scan, reduced to a row per node before the join.
    """
    labels = triples.filter((F.col("p") == predicate) & F.col("lang").isin(*languages))
    chosen = labels.groupBy(F.col("s").alias("_subject")).agg(*[
        F.min(F.when(F.col("lang") == lang, F.col("o"))).alias(f"_label_{lang}") for lang in languages
    ])
    joined = rows.join(chosen, F.col(on) == F.col("_subject"), "left")
    label = F.coalesce(*[F.col(f"_label_{lang}") for lang in languages], fallback)
    return joined.withColumn(out, F.when(F.col(on).isNotNull(), label)).drop(*chosen.columns)
