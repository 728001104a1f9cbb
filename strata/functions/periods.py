"""Years and run clocks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: published period codes count years from here (119 is 2019).
PERIOD_CODE_BASE = 1900


def decade(year: Column) -> Column:
    """``1995`` to ``1990s``."""
    start = year.cast("bigint") - F.pmod(year.cast("bigint"), F.lit(10))
    return F.concat(start.cast("string"), F.lit("s"))


def is_census_year(year: Column) -> Column:
    """Censuses fall on years ending in zero."""
    return F.pmod(year.cast("bigint"), F.lit(10)) == 0


def year_of_code(code: Column) -> Column:
    """Period code to calendar year."""
    return code.cast("bigint") + F.lit(PERIOD_CODE_BASE)


def file_tag(moment: Column) -> Column:
    """A timestamp as used in file names."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def run_clock() -> datetime:
    """The moment of a run, in UTC. Take it once per run and pass it on."""
    return datetime.now(timezone.utc)
