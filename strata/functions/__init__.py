"""Column functions. All are built-in Spark expressions; none needs Python on an executor."""

from strata.functions.numbers import (
    density, grouped_to_double, growth_pct, nan_to_null, per_capita, scale_to_long, to_double, to_long,
    ungroup, whole,
)
from strata.functions.periods import decade, file_tag, is_census_year, run_clock, year_of_code
from strata.functions.text import (
    clean_text, conform_exact, conform_title, match_key, null_placeholders, null_tokens, strip, text_after, title_case,
)

__all__ = [
    "clean_text", "conform_exact", "conform_title", "decade", "density", "file_tag",
    "grouped_to_double", "growth_pct", "is_census_year", "match_key", "nan_to_null",
    "null_placeholders", "null_tokens", "per_capita", "run_clock", "scale_to_long", "strip", "text_after", "title_case",
    "to_double", "to_long", "ungroup", "whole", "year_of_code",
]
