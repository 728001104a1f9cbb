"""Unions, pivots, constant columns and views."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct non-null values of ``column``; a frame without it contributes nothing.

    Each frame is reduced on its own before the union, so the last shuffle sees few rows.
    """
    having = [
        f.select(column).filter(F.col(column).isNotNull()).distinct() for f in frames if column in f.columns
    ]
    if not having:
        raise ValueError(f"no input has a column {column!r}")
    return reduce(DataFrame.unionByName, having).distinct()


def append_batches(*frames: DataFrame) -> DataFrame:
    """All rows of the batches, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def pivot_mean(
    df: DataFrame, index: Sequence[str], measure: str, value: str, columns: dict[str, str]
) -> DataFrame:
    """One row per ``index``; per measure code in ``columns`` the mean under its new name.

    Null cells do not count, and a group without any value disappears. The codes are
    given, so no extra job has to discover them.
    """
    cells = df.filter(F.col(value).isNotNull() & F.col(measure).isin(*columns))
    wide = cells.groupBy(*index).pivot(measure, list(columns)).agg(F.avg(value))
    return wide.withColumnsRenamed(columns)


def register(tables: dict[str, DataFrame]) -> None:
    """Make the frames available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
