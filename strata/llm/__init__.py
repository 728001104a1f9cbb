"""Operators for preparing training data: deduplication, filters, tokenizing, search, models.

Nothing else in the library imports this package. ``catalog.QUERIES`` holds its registered queries.
"""
