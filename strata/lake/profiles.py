"""Column profiles stored beside a batch of text columns, so that readers need not look at the cells first.

Whether a column holds plain or grouped numbers is a matter of all its cells. The profile of a batch is
taken by the job that writes it, and the profiles of several batches are merged: a column is
plain if it is plain in each. Reading numbers then takes one scan, where ``fmt="auto"`` takes two.

All parts of a profile are "all" or "any" over cells, so a task that runs twice changes nothing. A batch
without its profile was not finished and is refused. A column that a batch lacks, or has no cells
of, is plain there, like one of nulls only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.numbers import to_double
from strata.operators.clean import locale_numbers
from strata.sources.objects import read_text, write_text


@dataclass(frozen=True)
class ColumnProfile:
    """What is known of a text column: every cell is null or a plain number; some cell is null; some is not."""

    plain: bool = True
    has_null: bool = False
    has_value: bool = False

    def merge(self, other: ColumnProfile) -> ColumnProfile:
        return ColumnProfile(
            self.plain and other.plain, self.has_null or other.has_null, self.has_value or other.has_value)

    @property
    def format(self) -> str:
        return "plain" if self.plain else "grouped"


def write_profiled(df: DataFrame, path: str, columns: Sequence[str]) -> dict[str, ColumnProfile]:
    """Store ``df`` in a new folder and, taken on the way, the profile of those of ``columns`` that it has."""
    present = [c for c in columns if c in df.columns]
    seen = Observation()
    parts = {
        f"{i}_{kind}": F.coalesce(found, F.lit(empty))
        for i, c in enumerate(present)
        for kind, found, empty in (
            ("plain", F.bool_and(F.col(c).isNull() | to_double(F.col(c)).isNotNull()), True),
            ("has_null", F.bool_or(F.col(c).isNull()), False),
            ("has_value", F.bool_or(F.col(c).isNotNull()), False),
        )
    }
    observed = df.observe(seen, *[part.alias(name) for name, part in parts.items()]) if parts else df
    observed.write.parquet(f"{path}/data")
    got = seen.get if parts else {}
    profile = {
        c: ColumnProfile(*(got.get(f"{i}_{kind}", empty) for kind, empty in (("plain", True), ("has_null", False), ("has_value", False))))
        for i, c in enumerate(present)
    }
    write_text(df.sparkSession, f"{path}/profile.json", json.dumps({c: asdict(p) for c, p in profile.items()}), exclusive=True)
    return profile


def merged_profile(spark: SparkSession, paths: Sequence[str]) -> dict[str, ColumnProfile]:
    """The profile over all the batches; one small read a batch."""
    merged: dict[str, ColumnProfile] = {}
    for path in paths:
        text = read_text(spark, f"{path}/profile.json")
        if text is None:
            raise FileNotFoundError(f"no profile in {path}")
        for column, found in json.loads(text).items():
            merged[column] = merged.get(column, ColumnProfile()).merge(ColumnProfile(**found))
    return merged


def read_numbers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All the batches, each profiled column as doubles in the one format it has over all of them."""
    profile = merged_profile(spark, paths)
    batches = [spark.read.parquet(f"{path}/data") for path in paths]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
    for fmt in ("plain", "grouped"):
        rows = locale_numbers(rows, [c for c, found in profile.items() if found.format == fmt], fmt)
    return rows
