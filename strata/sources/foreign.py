"""CSV from elsewhere: columns bound by each file's header, records that cannot be read kept apart.

The header of every file is read on the driver (one small read a file); files with the same header are one
scan, and scans of different headers are united by name. So columns may be reordered from file to
file, files may have more columns than asked for, and nothing is ever bound by position.

Lines are parsed one by one, so that large files are split between tasks. A cell with a line break
makes the number of quotes in its line odd. Where that is not expected the scan fails, and nothing
of such a file is taken for a record. With ``multiline`` a first pass finds the files that have such
lines: these are parsed whole, each in one task, and all others are still split.

Defined results: a record with more or fewer cells than its header is rejected; so is, as a whole, a
file whose quotes do not pair up; a line equal to its file's header is no record wherever it stands; blank
lines are none either; a file without a header has no records; a byte order mark is no part of
the first name; of names that occur twice in a header none can be asked for.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.literals import literal_table

# Quotes are doubled inside quoted cells, and blanks at the ends of a cell are data.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

HEADER_BYTES = 1 << 16
_BAD = "bad"
REJECTED = "path string, record string, reason string"
CELLS, QUOTES = "cells", "quotes"
FAILURE = "unreadable source"  # how the message of a job that met a bad record begins


class UnreadableSource(ValueError):
    """A source that is there but cannot be read as what it should be."""


@dataclass(frozen=True)
class CsvScan:
    """The records of a scan by column, and those that cannot be read with their file and the reason."""

    rows: DataFrame
    rejected: DataFrame


def source_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files a scan of ``path`` would read, in order."""
    jvm = spark._jvm
    listed = spark.read.text(path if isinstance(path, str) else list(path)).inputFiles()
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString() for file in listed)


def _beginning(spark: SparkSession, file: str) -> str:
    """The first ``HEADER_BYTES`` of a file as text, decompressed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        body = (codec.createInputStream(stream) if codec is not None else stream).readNBytes(HEADER_BYTES)
    finally:
        stream.close()
    return bytes(body).decode("utf-8-sig", "replace")


def header_of(spark: SparkSession, file: str) -> tuple[tuple[str, ...], str] | None:
    """The names in a file's header and the header as it stands there, or None for a file without any."""
    lines = [line for line in re.split(r"(?<=\n)|(?<=\r)(?!\n)", _beginning(spark, file)) if line]
    taken: list[str] = []

    def feed() -> Iterator[str]:
        for line in lines:
            if taken or line.strip():
                taken.append(line)
                yield line

    record = next(csv.reader(feed()), None)
    if record is None:
        return None
    text = "".join(taken)
    if not text.endswith(("\r", "\n")) and len(text.encode()) >= HEADER_BYTES - 4:
        raise UnreadableSource(f"{file}: the header is longer than {HEADER_BYTES} bytes")
    return tuple(record), text.rstrip("\r\n")


def _bound(names: Sequence[str], columns: Sequence[str], missing: str, extra: str, file: str) -> Mapping[str, int | None]:
    """The place of each column in a header; None where it may be missing."""
    places = {}
    for column in columns:
        at = [i for i, name in enumerate(names) if name == column]
        if len(at) > 1 or not at and missing == "refuse":
            raise UnreadableSource(f"{file}: column {column!r} is {'there twice' if at else 'missing'} in {list(names)}")
        places[column] = at[0] if at else None
    if extra == "refuse" and set(names) - set(columns):
        raise UnreadableSource(f"{file}: columns {sorted(set(names) - set(columns))} are not expected")
    return places


def _quoted(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def _odd_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, int]:
    """For each file with such lines, the number of those with an odd number of quotes."""
    jvm = spark._jvm
    odd = spark.read.text(list(files)).where(_quoted(F.col("value")) % 2 == 1)
    found = odd.groupBy(F.col("_metadata.file_path").alias("path")).count().collect()
    return {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["path"])).toString(): r["count"] for r in found}


def _schema(width: int) -> str:
    return ", ".join([*(f"c{i} string" for i in range(width)), f"{_BAD} string"])


def _lines(spark: SparkSession, files: Sequence[str], headers: Sequence[str], width: int) -> DataFrame:
    """Cells and ``bad`` of every line, with its ``path``; fails on a line with an odd number of quotes."""
    lines = spark.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("path"))
    lines = lines.where((F.trim("value") != "") & ~F.col("value").isin(*headers))
    whole = F.when(_quoted(F.col("value")) % 2 == 0, True).otherwise(F.raise_error(F.concat(
        F.lit(f"{FAILURE}: a cell has a line break, read with multiline: "), "path", F.lit(": "), F.substring("value", 1, 200))))
    options = {**CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    parsed = lines.where(whole).select("path", F.from_csv("value", _schema(width), {k: str(v).lower() for k, v in options.items()}).alias("r"))
    return parsed.select("path", "r.*")


def _records(spark: SparkSession, files: Sequence[str], width: int) -> DataFrame:
    """Cells and ``bad`` of every record of files that are read whole, with its ``path``."""
    reader = spark.read.schema(_schema(width)).options(
        **CSV, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, columnPruning=False)
    return reader.csv(list(files)).select(F.col("_metadata.file_path").alias("path"), *[f"c{i}" for i in range(width)], _BAD)


@dataclass(frozen=True)
class _Part:
    """Files with one header: their cells with ``path`` and ``bad``, and the columns asked for."""

    cells: DataFrame
    asked: list[Column]


def _parts(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None, multiline: bool, missing: str, extra: str,
) -> tuple[list[str], list[_Part], list[str]]:
    """The columns, the files by header, and the files whose quotes do not pair up."""
    if missing not in ("refuse", "null") or extra not in ("drop", "refuse"):
        raise ValueError(f"unknown policy {missing!r}, {extra!r}")
    headers = {file: found for file in source_files(spark, path) if (found := header_of(spark, file)) is not None}
    if columns is None:
        if not headers:
            raise UnreadableSource(f"{path}: no file has a header")
        columns = next(iter(headers.values()))[0]
    odd = _odd_lines(spark, list(headers)) if multiline and headers else {}
    unpaired = [file for file in headers if odd.get(file, 0) % 2]

    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for file, (names, text) in headers.items():
        if file not in odd and ("\n" in text or "\r" in text):
            raise UnreadableSource(f"{file}: the header has a line break, read with multiline")
        if file not in unpaired:
            groups.setdefault((names, file in odd), []).append(file)
    parts = []
    for (names, whole), files in groups.items():
        places = _bound(names, columns, missing, extra, files[0])
        if whole:
            cells = _records(spark, files, len(names))
        else:
            cells = _lines(spark, files, sorted({headers[file][1] for file in files}), len(names))
        parts.append(_Part(cells, [
            (F.lit(None).cast("string") if at is None else F.col(f"c{at}")).alias(name) for name, at in places.items()]))
    return list(columns), parts, unpaired


def _no_rows(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return literal_table(spark, [], T.StructType([T.StructField(name, T.StringType()) for name in columns]))


def _text() -> Column:
    """The text of a bad record. Spark does not read it alone, so the first cell is looked at as well."""
    return F.when(F.length(F.coalesce("c0", F.lit(""))) >= 0, F.col(_BAD))


def scan_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, multiline: bool = False,
    missing: str = "refuse", extra: str = "drop",
) -> CsvScan:
    """The files below ``path`` by header, every cell a string, and the records that cannot be read.

    Without ``columns`` those of the first file are meant. ``missing`` columns are refused or ``"null"``,
    ``extra`` ones dropped or refused (``"refuse"``); refusal is an :class:`UnreadableSource`.
    """
    columns, parts, unpaired = _parts(spark, path, columns, multiline, missing, extra)
    rows = [part.cells.where(_text().isNull()).select(*part.asked) for part in parts]
    rejected = [part.cells.where(_text().isNotNull()).select("path", F.col(_BAD).alias("record"), F.lit(CELLS).alias("reason")) for part in parts]
    whole_files = literal_table(spark, [(file, None, QUOTES) for file in unpaired], REJECTED)
    return CsvScan(
        reduce(DataFrame.unionByName, rows) if rows else _no_rows(spark, columns),
        reduce(DataFrame.unionByName, rejected, whole_files),
    )


def read_by_header(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, multiline: bool = False,
    missing: str = "refuse", extra: str = "drop",
) -> DataFrame:
    """The rows of :func:`scan_csv`, where a record that cannot be read makes the job fail."""
    columns, parts, unpaired = _parts(spark, path, columns, multiline, missing, extra)
    if unpaired:
        raise UnreadableSource(f"quotes do not pair up in {unpaired}")
    message = F.concat(F.lit(f"{FAILURE}: a record has not the cells of its header: "), "path", F.lit(": "), F.substring(F.col(_BAD), 1, 200))
    whole = F.when(_text().isNull(), True).otherwise(F.raise_error(message))
    rows = [part.cells.where(whole).select(*part.asked) for part in parts]
    return reduce(DataFrame.unionByName, rows) if rows else _no_rows(spark, columns)
