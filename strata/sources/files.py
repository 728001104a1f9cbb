"""Table scans and sinks on any path Spark can reach."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import SCAN_NULL_TOKENS, null_tokens
from strata.sources.foreign import CSV, FAILURE, UnreadableSource, read_by_header
from strata.sources.literals import literal_table
from strata.sources.objects import exists

__all__ = [
    "as_cells", "count_in_place", "escape_breaks", "first_usable", "literal_table", "read_csv", "read_parquet", "read_with_fallback",
    "text_schema", "unescape_breaks", "unreadable", "write_csv", "write_parquet",
]

log = logging.getLogger(__name__)

# How line breaks are kept in files whose lines are split between tasks. A backslash is escaped
# too, and no escape begins within another, so each is undone by a plain replacement.
_BREAKS = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escape_breaks(text: Column) -> Column:
    """Text on one line: breaks and backslashes as a backslash and a letter."""
    for plain, escaped in _BREAKS:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape_breaks(text: Column) -> Column:
    """What ``escape_breaks`` was given."""
    for plain, escaped in reversed(_BREAKS):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def text_schema(columns: Sequence[str]) -> T.StructType:
    """A schema in which every column is a string."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def as_cells(rows: DataFrame, escaped: bool = False) -> DataFrame:
    """Text columns with placeholder cells null and, if ``escaped``, what ``write_csv`` does to line breaks undone."""
    cells = {c: null_tokens(F.col(f"`{c}`"), SCAN_NULL_TOKENS) for c in rows.columns}
    return rows.select([(unescape_breaks(cell) if escaped else cell).alias(c) for c, cell in cells.items()])


def read_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, multiline: bool = False,
    escaped: bool = False, missing: str = "refuse", extra: str = "drop",
) -> DataFrame:
    """CSV bound by header, every cell a string, placeholder cells null.

    Types are set later by explicit casts, so the file is scanned once. ``escaped`` undoes what
    ``write_csv`` does to line breaks. A record that cannot be read, or a cell with a line break
    where ``multiline`` is off, makes the job fail; ``foreign.scan_csv`` gives such records instead.
    """
    return as_cells(read_by_header(spark, path, columns, multiline, missing, extra), escaped)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV files that carry a header; line breaks in text are escaped."""
    texts = {f.name: escape_breaks(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)}
    df.withColumns(texts).write.mode("overwrite").options(**CSV).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet on any file system; filters and columns are pushed into the scan."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` with Parquet."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_with_fallback(
    spark: SparkSession, primary: str, alternate: str, columns: Sequence[str], multiline: bool = False, escaped: bool = False,
) -> DataFrame:
    """Read ``primary``, or ``alternate`` where the primary is absent, unreadable or without rows.

    The choice is made when the plan is built. Both must hold exactly ``columns``, in any order. Failures
    of other kinds, a lost cluster say, are no reason to take an old file for new and are raised.
    """
    options = {"multiline": multiline, "escaped": escaped, "extra": "refuse"}
    found = first_usable(lambda: read_csv(spark, primary, columns, **options) if exists(spark, primary) else None)
    return found if found is not None else read_csv(spark, alternate, columns, **options)


# Conditions by which Spark says that input is absent or is not what it should be.
_UNREADABLE = re.compile(
    rf"\[(PATH_NOT_FOUND|FAILED_READ_FILE|MALFORMED_|INVALID_JSON|UNABLE_TO_INFER_SCHEMA|CANNOT_READ_FILE|CANNOT_PARSE)|{FAILURE}")


def unreadable(error: Exception) -> bool:
    """Whether a failure lies in the input."""
    return isinstance(error, UnreadableSource) or _UNREADABLE.search(str(error)) is not None


def first_usable(read: Callable[[], DataFrame | None]) -> DataFrame | None:
    """What ``read`` gives, or None where it gives nothing, its input is unreadable, or it has no rows."""
    try:
        found = read()
        if found is not None and not found.isEmpty():
            return found
    except (UnreadableSource, PySparkException, Py4JJavaError) as error:
        if not unreadable(error):
            raise
        log.warning("source left out: %s", str(error).splitlines()[0])
    return None


def count_in_place(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``count(*)`` straight over a file path, without registering a table."""
    if fmt == "parquet":
        return spark.sql("SELECT count(*) AS records FROM parquet.`" + path + "`")
    if fmt == "csv":
        return spark.read.options(**CSV).csv(path).agg(F.count(F.lit(1)).alias("records"))
    raise ValueError(f"unknown format {fmt!r}")
