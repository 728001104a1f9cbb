"""Cleaning whole frames: text columns, audit columns, casts, number formats, deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.functions.numbers import grouped_to_double, to_double
from strata.functions.text import null_placeholders, strip

# The audit columns that landing appends.
AUDIT_COLUMNS = ("ingestion_timestamp", "source_name", "operator_id")


def clean_strings(
    df: DataFrame, steps: Sequence[Callable[[Column], Column]] = (strip, null_placeholders)
) -> DataFrame:
    """Apply ``steps`` to every string column.

    Each step is a projection of its own, so that a step which looks at its input twice does not
    repeat the steps before.
    """
    for step in steps:
        df = df.select([
            step(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ])
    return df


def drop_audit(df: DataFrame) -> DataFrame:
    """Drop the audit columns, whichever of them exist."""
    return df.drop(*AUDIT_COLUMNS)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select([c for c in columns if c in df.columns])


def convert_existing(df: DataFrame, conversions: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Convert the listed columns that exist."""
    return df.withColumns({c: to(F.col(c)) for c, to in conversions.items() if c in df.columns})


def locale_numbers(df: DataFrame, columns: Sequence[str], fmt: str = "auto") -> DataFrame:
    """Text columns to double.

    ``plain`` reads ``3403166.85``; ``grouped`` reads ``3.403.166,85``. ``auto`` decides per
    column: plain if every cell is a plain number, otherwise grouped for the whole column. A column
    that mixes both formats is therefore read as grouped and its plain cells lose their point;
    name the format where that can happen. ``auto`` adds one pass that aggregates to one row.
    """
    present = [c for c in columns if c in df.columns]
    if fmt == "plain":
        return convert_existing(df, dict.fromkeys(present, to_double))
    if fmt == "grouped":
        return convert_existing(df, dict.fromkeys(present, grouped_to_double))
    if fmt != "auto":
        raise ValueError(f"unknown number format {fmt!r}")
    if not present:
        return df
    plain = df.agg(*[
        F.coalesce(F.bool_and(F.col(c).isNull() | to_double(F.col(c)).isNotNull()), F.lit(True))
        .alias(f"_plain_{c}")
        for c in present
    ])
    flagged = df.crossJoin(F.broadcast(plain))  # one row
    parsed = flagged.withColumns({
        c: F.when(F.col(f"_plain_{c}"), to_double(F.col(c))).otherwise(grouped_to_double(F.col(c)))
        for c in present
    })
    return parsed.drop(*plain.columns)


def rejected(before: Column, after: Column) -> Column:
    """Count of cells that held something and lost it in a cast."""
    return F.count_if(before.isNotNull() & after.isNull())


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order_by``; rows with a null key form one key.

    The rank limit runs before the shuffle as well, so each task sends at most one row per key
    and a key that holds most rows does not load one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")


def latest_with_ties(df: DataFrame, entity: str, moment: str) -> DataFrame:
    """Rows at each entity's latest ``moment``, all ties kept; rows without a moment are left out.

    An aggregate and a join rather than a rank: the aggregate shrinks before the shuffle, and
    an entity with very many tied rows is split by the skew join, not sorted in one task.
    """
    dated = df.filter(F.col(moment).isNotNull())
    latest = dated.groupBy(entity).agg(F.max(moment).alias(moment))
    return dated.join(latest, [entity, moment], "left_semi")
