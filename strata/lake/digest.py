"""A table digest that does not depend on row order or partitioning.

Each row is rendered as JSON (a null field is absent, an empty one is ``""``) and hashed; the first
60 bits of the hashes are summed. A sum counts duplicates, which an exclusive-or would
cancel. The sum and the row count reduce inside each task, so a hot value costs nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEX_DIGITS = 15
# The 60 bits are summed in four pieces of 15 bits. A piece stays within a bigint for 2^48 rows, and
# bigint sums are several times faster than a decimal sum of the whole.
_PIECE_BITS = 15
PIECES = [f"piece_{i}" for i in range(4)]


def row_md5(df: DataFrame) -> Column:
    """MD5 of one row's JSON text."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))


def digest_aggregates(df: DataFrame) -> list[Column]:
    """The aggregates behind a digest; also usable as observed metrics of a write."""
    number = F.conv(F.substring(row_md5(df), 1, _HEX_DIGITS), 16, 10).cast("bigint")
    mask = F.lit((1 << _PIECE_BITS) - 1)
    return [F.count(F.lit(1)).alias("records")] + [
        F.coalesce(F.sum(F.shiftright(number, i * _PIECE_BITS).bitwiseAND(mask)), F.lit(0)).alias(piece)
        for i, piece in enumerate(PIECES)
    ]


def schema_map(df: DataFrame) -> dict[str, str]:
    """Column name to type name, in column order."""
    return dict(df.dtypes)


def schema_text(df: DataFrame) -> str:
    """The schema as one line; part of the digest, so a type change is a change."""
    return ",".join(f"{name}:{kind}" for name, kind in df.dtypes)


def whole_sum(*pieces: Column) -> Column:
    """The sum of row digests from the sums of its pieces."""
    return sum(
        (piece.cast("decimal(38,0)") * F.lit(1 << i * _PIECE_BITS) for i, piece in enumerate(pieces)), start=F.lit(0),
    ).cast("decimal(38,0)")


def table_digest(df: DataFrame) -> DataFrame:
    """One row ``records, digest``."""
    sums = df.agg(*digest_aggregates(df))
    whole = whole_sum(*[F.col(piece) for piece in PIECES])
    sealed = F.md5(F.concat_ws("|", F.lit(schema_text(df)), "records", whole.cast("string")))
    return sums.select("records", sealed.alias("digest"))


def seal(df: DataFrame, metrics: dict) -> str:
    """The digest from observed aggregates; equals that of :func:`table_digest`."""
    whole = sum(metrics[piece] << i * _PIECE_BITS for i, piece in enumerate(PIECES))
    text = f"{schema_text(df)}|{metrics['records']}|{whole}"
    return hashlib.md5(text.encode("utf-8")).hexdigest()
