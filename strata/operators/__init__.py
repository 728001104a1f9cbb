"""DataFrame operators: cleaning, lookups, merges, keys, reshaping and graph patterns."""

from strata.operators.clean import (
    AUDIT_COLUMNS, clean_strings, convert_existing, drop_audit, keep_first, latest_with_ties,
    locale_numbers, rejected, select_existing,
)
from strata.operators.joins import (
    NAME_ALIASES, alias_lookup, key_lookup, label_lookup, member_rows, outer_merge, resolve_names,
    unmatched,
)
from strata.operators.keys import dense_key
from strata.operators.reshape import append_batches, distinct_values, pivot_mean, register

__all__ = [
    "AUDIT_COLUMNS", "NAME_ALIASES", "alias_lookup", "append_batches", "clean_strings",
    "convert_existing", "dense_key", "distinct_values", "drop_audit", "keep_first", "key_lookup",
    "label_lookup", "latest_with_ties", "locale_numbers", "member_rows", "outer_merge",
    "pivot_mean", "register", "rejected", "resolve_names", "select_existing", "unmatched",
]
