"""Registered queries of this package, each with its SQL where SQL can say it."""

from strata.llm import (
    bpe, chunks, decontaminate, language, merkle, mixing, near_duplicates, nearest, pages, ranking, shards, suffixes, toxicity,
)
from strata.llm.shipping import shipped

MODULES = (chunks, mixing, pages, toxicity, bpe, near_duplicates, nearest, decontaminate, suffixes, language, shards, merkle, ranking)
QUERIES = {name: (shipped(build), sql) for module in MODULES for name, (build, sql) in module.QUERIES.items()}
