"""Registered queries over the given tables, each with its oracle SQL where SQL can say it."""

from strata.catalog import cleaning, lakehouse, shapes, star

QUERIES = {**star.QUERIES, **cleaning.QUERIES, **shapes.QUERIES, **lakehouse.QUERIES}
