"""Lookups, alias matching and the null-safe outer merge.

No side is broadcast by hint. Spark compares the size of each with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import match_key
from strata.sources.files import literal_table

# Match names under which an entity may also be listed, best first.
NAME_ALIASES = {
    "kepulauan bangka belitung": ["kepulauan bangka belitung", "bangka belitung islands"],
    "dki jakarta": ["dki jakarta", "jakarta"],
    "di yogyakarta": [
        "di yogyakarta", "daerah istimewa yogyakarta", "special region of yogyakarta", "yogyakarta",
    ],
    "nanggroe aceh darussalam": ["aceh"],
}


def label_lookup(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Attach the label columns of ``codes``; rows with an unknown code are dropped."""
    return df.join(codes, code, "inner")


def member_rows(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Rows whose code is listed; a code listed twice does not repeat them."""
    return df.join(codes, code, "left_semi")


def key_lookup(df: DataFrame, dim: DataFrame, on: str, key: str) -> DataFrame:
    """Attach ``key`` of the dimension row with the same ``on``; null where there is none."""
    return df.join(dim.select(on, key), on, "left")


def alias_rows(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """The alias lists as rows ``name_key, rank, candidate``; rank 0 is the name itself."""
    rows = [
        (name, rank, candidate)
        for name, candidates in aliases.items()
        for rank, candidate in enumerate([name, *candidates])
    ]
    return literal_table(df.sparkSession, rows, "name_key string, rank int, candidate string")


def alias_lookup(
    dim: DataFrame, key: str, names: Sequence[str], aliases: dict[str, list[str]] = NAME_ALIASES
) -> DataFrame:
    """Every name that resolves, with its dimension key: ``name_key, <key>``.

    A name resolves to the best-ranked candidate found in any of ``names``, then to the lowest
    key. It is built from the dimension alone, so it has dimension size and no pass over the
    rows to be matched is needed.
    """
    listed = reduce(DataFrame.unionByName, [
        dim.select(F.col(n).alias("candidate"), F.col(key)) for n in names
    ]).filter(F.col("candidate").isNotNull())
    own = listed.select(F.col("candidate").alias("name_key"), F.lit(0).alias("rank"), key)
    through = listed.join(alias_rows(dim, aliases), "candidate").select(
        "name_key", "rank", key
    )
    best = own.unionByName(through).groupBy("name_key").agg(F.min(F.struct("rank", key)).alias("best"))
    return best.select("name_key", F.col(f"best.{key}").alias(key))


def resolve_names(df: DataFrame, lookup: DataFrame, name: str, key: str) -> DataFrame:
    """Attach ``key`` by match name; null where the name does not resolve."""
    keyed = df.withColumn("name_key", match_key(F.col(name)))
    return keyed.join(lookup, "name_key", "left").drop("name_key").select(*df.columns, key)


def unmatched(df: DataFrame, lookup: DataFrame, name: str) -> DataFrame:
    """Sorted distinct names that do not resolve; null names are not reported."""
    names = df.select(name).filter(F.col(name).isNotNull()).distinct()
    keyed = names.withColumn("name_key", match_key(F.col(name)))
    return keyed.join(lookup, "name_key", "left_anti").select(name).orderBy(name)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys`` where null matches null, with one set of key columns.

    Made of an inner join and two anti joins against distinct keys. A single full outer join
    cannot split a hot key on either side; here the inner join can split both sides, and the
    distinct keys shrink before they are shuffled. Each side is read up to three times: store one
    that is expensive to compute.
    """
    l, r = left.alias("l"), right.alias("r")
    left_keys, right_keys = left.select(*keys).distinct(), right.select(*keys).distinct()
    extra = [c for c in right.columns if c not in keys]
    both = l.join(r, _same("l", "r", keys)).select("l.*", *[F.col(f"r.{c}") for c in extra])
    left_only = l.join(right_keys.alias("k"), _same("l", "k", keys), "left_anti")
    right_only = r.join(left_keys.alias("k"), _same("r", "k", keys), "left_anti")
    return both.unionByName(left_only, allowMissingColumns=True).unionByName(
        right_only, allowMissingColumns=True
    )
