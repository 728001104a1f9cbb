"""Column functions on edge values."""

import pytest
from pyspark.sql import functions as F

from strata.functions import numbers as N
from strata.functions import periods as P
from strata.functions import text as X


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v")), "i").orderBy("i").collect()]


def test_strip_removes_every_kind_of_white_space(spark):
    assert apply(spark, X.strip, [" a b\t", " x 　", "\x1cy\x85", "", None]) == ["a b", "x", "y", "", None]


def test_clean_text_tokens_are_exact_case(spark):
    cells = [" NA ", "NULL", "None", "nan", "  ", "null", "na", "N/A", " x ", None]
    assert apply(spark, X.clean_text, cells) == [None, None, None, None, None, "null", "na", "N/A", "x", None]


def test_scan_tokens_are_compared_unstripped(spark):
    cells = ["n/a", "#N/A", "null", " NA", "NA", "", "-nan", "x"]
    nulled = apply(spark, lambda c: X.null_tokens(c, X.SCAN_NULL_TOKENS), cells)
    assert nulled == [None, None, None, " NA", None, None, None, "x"]


@pytest.mark.parametrize("raw", ["D.I. ACEH", "o'neil mc-x", " nusa  TENGGARA barat", "ÉCOLE élan", "a1b", ""])
def test_title_case_starts_every_run_of_letters(spark, raw):
    assert apply(spark, X.title_case, [raw]) == [raw.title()]


def test_conform(spark):
    assert apply(spark, X.conform_exact, [" D.K.I Jakarta ", "d.k.i jakarta", "Bangka Belitung", None]) == [
        "DKI Jakarta", "d.k.i jakarta", "Kepulauan Bangka Belitung", None,
    ]
    assert apply(spark, X.conform_title, [" kep. riau", "D.I. YOGYAKARTA", "PAPUA BARAT", None]) == [
        "Kepulauan Riau", "DI Yogyakarta", "Papua Barat", None,
    ]
    assert apply(spark, X.match_key, ["\tDKI Jakarta ", None]) == ["dki jakarta", None]


def test_text_after_takes_the_first_occurrence(spark):
    assert apply(spark, lambda c: X.text_after(c, "/e/"), ["x/e/Q1/e/2", "none", "/e/", None]) == ["Q1/e/2", "", "", None]


def test_to_double(spark):
    cells = ["1", " 2.5 ", " 3", "-4e2", ".5", "5.", "1d", "2.0F", "0x1p3", "nan", "NaN", "1_000", "1,5", "", "x", None]
    assert apply(spark, N.to_double, cells) == [1, 2.5, 3, -400, 0.5, 5] + [None] * 10
    assert apply(spark, N.to_double, ["inf", "-Infinity"]) == [float("inf"), float("-inf")]


def test_to_long_nulls_what_would_lose_a_fraction(spark):
    cells = ["12", " 12.0 ", "12.5", "1e3", "9223372036854775807", "99999999999999999999", "x", "", None]
    assert apply(spark, N.to_long, cells) == [12, 12, None, 1000, 2**63 - 1, None, None, None, None]


def test_grouped_numbers(spark):
    cells = ["15.386,6", "1.234.567", " 7,5\t", "-", "–", "...", "", "NA", "-1.000,5", "abc", None]
    assert apply(spark, N.grouped_to_double, cells) == [
        15386.6, 1234567, 7.5, None, None, None, None, None, -1000.5, None, None,
    ]


def test_ratios_and_rounding(spark):
    assert apply(spark, lambda c: N.scale_to_long(c, 1), [0.5, 1.5, 2.5, -0.5, None], "double") == [0, 2, 2, 0, None]
    assert apply(spark, lambda c: N.scale_to_long(c, 1000), [15386.6, 0.0005], "double") == [15386600, 0]
    assert apply(spark, lambda c: N.per_capita(F.lit(10.0), c), [4, 0, None], "bigint") == [2500.0, None, None]
    assert apply(spark, lambda c: N.growth_pct(F.lit(3.0), c), [2.0, 0.0, None], "double") == [50.0, None, None]
    assert apply(spark, N.nan_to_null, [float("nan"), 1.0, float("inf"), None], "double") == [None, 1.0, float("inf"), None]


def test_periods(spark):
    assert apply(spark, P.decade, [2019, 2020, 1999], "bigint") == ["2010s", "2020s", "1990s"]
    assert apply(spark, P.is_census_year, [2019, 2020], "bigint") == [False, True]
    assert apply(spark, P.year_of_code, [119, 123], "bigint") == [2019, 2023]
