"""Tables as groups of files, so that what did not change is not written again.

A group is all rows with one value of a grouping: a hash bucket of the key, or a period. Each group has
a digest of its own, of which the table's digest is the sum (``strata.lake.digest``). A write
takes the digests of what is to be stored, stores the groups whose digest differs from the one known, and
refers to the files of all others. Folders are never changed once written.

One group is a folder of any number of files: rows are dealt to tasks by group, and Spark cuts
large groups and joins small ones. Only one line a group comes to the driver, and a grouping with
more than ``MAX_GROUPS`` values is refused.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.lake.digest import PIECES, digest_aggregates, schema_text, whole_sum
from strata.sources.literals import literal_table

MAX_GROUPS = 10_000

# How groups stand in a log entry or a manifest.
GROUPS_SCHEMA = "groups array<struct<name:string,path:string,records:bigint,digest:string>>"
GROUPING_SCHEMA = f"grouping string, group_schema string, group_columns string, {GROUPS_SCHEMA}"


@dataclass(frozen=True)
class Grouping:
    """How rows are grouped, under a name by which later writes know that it is the same way."""

    name: str
    column: Column

    def label(self) -> Column:
        return self.column.cast("string")


def by_hash(keys: Sequence[str], buckets: int = 64) -> Grouping:
    """Groups of about equal size by the hash of the key; equal keys are in one group."""
    if not 1 <= buckets <= MAX_GROUPS:
        raise ValueError(f"cannot make {buckets} buckets")
    return Grouping(f"hash({','.join(keys)}):{buckets}", F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)))


def by_value(name: str, column: Column | None = None) -> Grouping:
    """One group for each value of a column, or of an expression called ``name``; null is a value."""
    return Grouping(f"value({name})", F.col(name) if column is None else column)


@dataclass(frozen=True)
class Group:
    """One group as it is stored: its folder below the table, row count, and sum of row digests."""

    name: str | None
    path: str
    records: int
    digest: str

    def same_rows(self, other: Group | None) -> bool:
        return other is not None and (self.records, self.digest) == (other.records, other.digest)


@dataclass(frozen=True)
class Stored:
    """The groups of a table after a write, and which of them the write stored, kept and dropped."""

    groups: tuple[Group, ...]
    written: tuple[Group, ...]
    dropped: tuple[Group, ...]
    grouping: str
    schema: str
    columns: str

    @property
    def records(self) -> int:
        return sum(group.records for group in self.groups)

    @property
    def checksum(self) -> str:
        """The table's digest; equals that of ``table_digest`` over its rows."""
        total = sum(int(group.digest) for group in self.groups)
        return hashlib.md5(f"{self.schema}|{self.records}|{total}".encode()).hexdigest()

    def entry(self) -> dict:
        """The fields for a log entry or a manifest."""
        groups = [asdict(group) for group in self.groups]
        return {"grouping": self.grouping, "group_schema": self.schema, "group_columns": self.columns, "groups": groups}


def known_groups(entry: Mapping | None, grouping: Grouping, df: DataFrame) -> tuple[Group, ...]:
    """The groups of a log entry or manifest, none if it has another grouping or schema."""
    if entry is None or entry["groups"] is None or (entry["grouping"], entry["group_schema"]) != (grouping.name, schema_text(df)):
        return ()
    return groups_of(entry)


def groups_of(entry: Mapping) -> tuple[Group, ...]:
    return tuple(Group(**group.asDict()) for group in entry["groups"])


def group_digests(df: DataFrame, label: Column, columns: DataFrame | None = None) -> DataFrame:
    """``name``, ``records`` and ``digest`` (the sum of row digests) of every group.

    Rows are digested over the columns of ``columns``, by default all.
    """
    sums = df.groupBy(label.alias("name")).agg(*digest_aggregates(columns if columns is not None else df))
    return sums.select("name", "records", whole_sum(*[F.col(piece) for piece in PIECES]).cast("string").alias("digest"))


def _collected(digests: DataFrame) -> dict[str | None, Group]:
    rows = digests.limit(MAX_GROUPS + 1).collect()
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups; take a coarser grouping")
    return {r["name"]: Group(r["name"], "", r["records"], r["digest"]) for r in rows}


def _free(name: str, columns: Sequence[str]) -> str:
    """``name``, longer by underscores if there is such a column."""
    taken = {column.lower() for column in columns}
    while name in taken:
        name += "_"
    return name


def store_groups(
    df: DataFrame, table: str, folder: str, grouping: Grouping, known: Iterable[Group], absent: str = "drop",
    constants: Mapping[str, Column] | None = None,
) -> Stored:
    """Store the groups of ``df`` that differ from the ``known`` ones below ``table/folder``.

    Known groups that ``df`` has no row of are dropped, or kept (``absent="keep"``) where ``df`` holds the
    groups of one delivery only. ``constants`` are columns added to what is stored; they are no part of
    digests. ``df`` is read twice if anything changed. Digests of stored groups come from the stored files.
    """
    if absent not in ("drop", "keep"):
        raise ValueError(f"unknown policy for absent groups {absent!r}")
    spark = df.sparkSession
    before = {group.name: group for group in known}
    found = _collected(group_digests(df, grouping.label()))
    changed = sorted((name for name, group in found.items() if not group.same_rows(before.get(name))), key=lambda n: (n is not None, n))
    written: dict[str | None, Group] = {}
    if changed:
        numbers = {name: at for at, name in enumerate(changed)}
        group, part = (_free(name, [*df.columns, *(constants or {})]) for name in ("group", "part"))
        label = F.col(group)
        named = {name: at for name, at in numbers.items() if name is not None}
        number = F.element_at(F.create_map(*[F.lit(x) for pair in named.items() for x in pair]), label) if named else F.lit(None).cast("int")
        if None in numbers:
            number = F.when(label.isNull(), F.lit(numbers[None])).otherwise(number)
        marked = df.withColumn(group, grouping.label()).where(
            label.isin(list(named)) | (label.isNull() if None in numbers else F.lit(False)))
        marked = marked.withColumn(part, number).drop(group).withColumns(dict(constants or {}))
        marked.hint("rebalance", part).write.partitionBy(part).parquet(f"{table}/{folder}")

        stored = spark.read.schema(marked.schema).parquet(f"{table}/{folder}")
        names = dict(enumerate(changed))
        for at, seen in _collected(group_digests(stored, F.col(part).cast("string"), df)).items():
            name = names[int(at)]
            written[name] = Group(name, f"{folder}/{part}={at}", seen.records, seen.digest)
    kept = {name: group for name, group in before.items() if name not in written and (absent == "keep" or name in found)}
    dropped = tuple(group for name, group in before.items() if name not in kept)
    live = sorted([*kept.values(), *written.values()], key=lambda group: (group.name is not None, group.name))
    return Stored(tuple(live), tuple(written[name] for name in changed if name in written), dropped, grouping.name, schema_text(df), df.schema.json())


def read_groups(spark: SparkSession, table: str, entry: Mapping) -> DataFrame:
    """The rows of all groups of a log entry or manifest."""
    paths = [f"{table}/{group.path}" for group in groups_of(entry)]
    if paths:
        return spark.read.parquet(*paths)
    return literal_table(spark, [], StructType.fromJson(json.loads(entry["group_columns"])))
