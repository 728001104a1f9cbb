"""Numeric columns: tolerant casts, locale numbers, safe ratios, integer rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import strip

# A decimal number or an infinity. Matching first keeps out what the JVM parser would also take:
# type suffixes (``1d``), hexadecimal, and not-a-number, which means missing.
_NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\z"
_WHOLE = r"\A[+-]?[0-9]+(?:\.0*)?\z"


def nan_to_null(number: Column) -> Column:
    """Not-a-number means missing; Spark would otherwise sort it above every value."""
    return F.when(~F.isnan(number), number)


def to_double(text: Column) -> Column:
    """Text to double, null where it is no number; white space around it does not count."""
    bare = strip(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def whole(number: Column) -> Column:
    """Double to bigint, null where a fraction would be lost."""
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def to_long(text: Column) -> Column:
    """Text to bigint, null where it is no number or a fraction would be lost; ``12.0`` is 12."""
    bare = strip(text)
    digits = F.when(bare.rlike(_WHOLE), F.substring_index(bare, ".", 1).try_cast("bigint"))
    return F.coalesce(digits, whole(to_double(text)))


def ungroup(text: Column) -> Column:
    """``1.234.567,8`` to ``1234567.8``: drop thousands points, make the comma a point."""
    return F.translate(text, ",.", ".")


def grouped_to_double(text: Column) -> Column:
    """A number printed with thousands points and a decimal comma; null where it is none.

    The marks for "no figure" (nothing, ``-``, ``–``, ``...``, ``NA``) are no numbers either.
    """
    return to_double(ungroup(text))


def scale_to_long(number: Column, factor: int) -> Column:
    """Multiply and round half to even, e.g. thousands of people to people."""
    return F.bround(number * F.lit(float(factor))).try_cast("bigint")


def per_capita(total: Column, population: Column, scale: int = 1000) -> Column:
    """``total * scale / population``; null, not infinity, where nobody is counted."""
    return F.try_divide(total * F.lit(float(scale)), population.cast("double"))


def density(count: Column, area: Column) -> Column:
    """Head count over area; null where the area is zero."""
    return F.try_divide(count.cast("double"), area)


def growth_pct(now: Column, before: Column) -> Column:
    """Relative change in percent; null for the first period and after a zero."""
    return F.try_divide(now - before, before) * F.lit(100.0)
