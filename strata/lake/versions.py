"""Versioned tables: immutable snapshots and a log that commits them.

A write puts its files into a folder of its own and then creates the log entry
``log/00000007.json``, whole and without replacing any. The entry is the commit: a folder without
one is never read, nor is an entry that does not parse. Of two writers one gets the number and
the other takes the next; neither can overwrite the other's files. Old versions stay readable, so no
copy is made before a write. A commit over several tables names one version of each.

``write_version`` stores the whole table. ``write_groups`` stores what changed since the version before,
by groups of rows, and its entry names the folders of all groups, those of earlier versions included.
Every ten versions the log is summarized in one Parquet file; readers take it and the entries behind it.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.periods import run_clock
from strata.lake.digest import digest_aggregates, schema_map, seal, table_digest
from strata.lake.groups import GROUPING_SCHEMA, Grouping, Stored, known_groups, read_groups, store_groups
from strata.sources.objects import ObjectExists, every_object, exists, read_text, write_text

log = logging.getLogger(__name__)
SUMMARY_EVERY = 10

# The fields of a log entry.
LOG_SCHEMA = (
    "version bigint, timestamp string, operation string, operation_parameters map<string,string>, "
    "added_files array<string>, removed_files array<string>, num_records bigint, "
    f"schema map<string,string>, checksum string, {GROUPING_SCHEMA}"
)


@dataclass(frozen=True)
class Version:
    """A committed version."""

    version: int
    path: str
    num_records: int
    checksum: str


def current_version(spark: SparkSession, table: str) -> int:
    """Highest version with a whole log entry, -1 for a table without any."""
    if not exists(spark, f"{table}/log"):
        return -1
    return history(spark, table).agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]


def next_version(spark: SparkSession, folder: str) -> int:
    """The number after the highest that any file of a log folder has, whole or not.

    Numbers have no gaps, so those behind the log's summary are tried one after the other.
    """
    if not exists(spark, folder):
        return 0
    summary = _summary(spark, folder.removesuffix("/log")) if folder.endswith("/log") else None
    if summary is not None:
        return summary[0] + 1 + len(_behind(spark, folder, summary[0]))
    number = F.regexp_extract("path", r"/([0-9]+)\.json$", 1).try_cast("bigint")
    return every_object(spark, folder).agg(F.coalesce(F.max(number), F.lit(-1))).first()[0] + 1


def _commit(spark: SparkSession, folder: str, entry: Mapping[str, object]) -> int:
    """Store an entry under the first free number; gives the number."""
    version = next_version(spark, folder)
    while True:
        text = json.dumps({"version": version, **entry}, ensure_ascii=False)
        try:
            write_text(spark, f"{folder}/{version:08d}.json", text, exclusive=True)
            return version
        except ObjectExists:
            version += 1


def _behind(spark: SparkSession, folder: str, version: int) -> list[str]:
    """The log's files after ``version``."""
    found = []
    while exists(spark, path := f"{folder}/{version + 1 + len(found):08d}.json"):
        found.append(path)
    return found


def _summary(spark: SparkSession, table: str) -> tuple[int, DataFrame] | None:
    """The last version that the log's summary has, and its entries; None without a whole one."""
    named = read_text(spark, f"{table}/log_summary/latest.txt")
    if named is None:
        return None
    try:
        version, entries, folder = named.split()
        found = spark.read.schema(LOG_SCHEMA).parquet(f"{table}/log_summary/{folder}")
        return (int(version), found) if found.count() == int(entries) else None
    except (ValueError, PySparkException, Py4JJavaError) as error:
        log.warning("summary of %s left out: %s", table, str(error).splitlines()[0])
        return None


def summarize(spark: SparkSession, table: str) -> None:
    """Store the whole log as one Parquet file, which readers take instead of its entries.

    Writers do so after every ``SUMMARY_EVERY`` versions. The summary is no part of a commit: one that is
    missing, old or damaged costs time only.
    """
    entries = history(spark, table)
    version = entries.agg(F.max("version")).first()[0]
    if version is None:
        return
    folder = f"{version:08d}-{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(f"{table}/log_summary/{folder}")
    stored = spark.read.schema(LOG_SCHEMA).parquet(f"{table}/log_summary/{folder}")
    write_text(spark, f"{table}/log_summary/latest.txt", f"{version} {stored.count()} {folder}")


def _commit_version(spark: SparkSession, table: str, entry: Mapping[str, object]) -> int:
    version = _commit(spark, f"{table}/log", entry)
    if (version + 1) % SUMMARY_EVERY == 0:
        try:
            summarize(spark, table)
        except (PySparkException, Py4JJavaError) as error:
            log.warning("no summary of %s: %s", table, str(error).splitlines()[0])
    return version


def write_version(
    df: DataFrame, table: str, operation: str = "WRITE", parameters: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> Version:
    """Store ``df`` as the next version. Row count and digest come out of the same pass.

    With ``partition_by`` there is a folder for each value of these columns, of few files: rows are dealt
    by the columns, where Spark cuts large values and joins small ones. Filters and joins on them then
    read the folders they need only.
    """
    spark = df.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    seen = Observation(f"version-{folder}")
    rows = df.observe(seen, *digest_aggregates(df))
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.partitionBy(*partition_by).parquet(f"{table}/{folder}")
    records, checksum = _checked(df, seen.get, spark.read.schema(df.schema).parquet(f"{table}/{folder}"))
    entry = {
        "timestamp": run_clock().isoformat(),
        "operation": operation,
        "operation_parameters": dict(parameters or {"mode": "Overwrite"}),
        "added_files": [folder],
        "removed_files": [],
        "num_records": records,
        "schema": schema_map(df),
        "checksum": checksum,
    }
    if partition_by:
        entry["group_columns"] = df.schema.json()
    version = _commit_version(spark, table, entry)
    return Version(version, f"{table}/{folder}", records, checksum)


def write_groups(
    df: DataFrame, table: str, grouping: Grouping, operation: str = "WRITE", parameters: Mapping[str, str] | None = None,
    absent: str = "drop",
) -> tuple[Version, Stored]:
    """Store ``df`` as the next version, writing only the groups that differ from the newest version's.

    ``absent="keep"`` leaves groups without a row in ``df`` as they are, so ``df`` may hold some periods
    only. A version of another grouping or schema shares nothing. Of two writers at once each commits its own
    rows with the groups it found; with ``"keep"`` run one at a time.
    """
    spark = df.sparkSession
    newest = _entry(spark, table, None)
    folder = f"data/{uuid.uuid4().hex}"
    stored = store_groups(df, table, folder, grouping, known_groups(newest, grouping, df), absent)
    # a group stored anew takes the place of its folder before
    gone = sorted(set(newest["added_files"] if newest else []) if newest and newest["groups"] is None else {g.path for g in stored.dropped})
    version = _commit_version(spark, table, {
        "timestamp": run_clock().isoformat(),
        "operation": operation,
        "operation_parameters": dict(parameters or {"mode": "Overwrite"}),
        "added_files": [group.path for group in stored.written],
        "removed_files": gone,
        "num_records": stored.records,
        "schema": schema_map(df),
        "checksum": stored.checksum,
        **stored.entry(),
    })
    return Version(version, f"{table}/{folder}", stored.records, stored.checksum), stored


def _checked(df: DataFrame, metrics: dict, stored: DataFrame) -> tuple[int, str]:
    """Count and digest of a write, checked against the stored file footers.

    Observed metrics may miscount where a lost executor made Spark repeat a stage, or be
    absent where an empty input was optimized away; then the stored table is read instead.
    """
    records = stored.count()
    if metrics.get("records") == records:
        return records, seal(df, metrics)
    row = table_digest(stored).first()
    return row["records"], row["digest"]


def history(spark: SparkSession, table: str) -> DataFrame:
    """The log as a table in version order; entries that do not parse are skipped.

    Read are the newest summary and the entries behind it, or all entries where there is no summary.
    """
    reader = spark.read.schema(LOG_SCHEMA).option("mode", "DROPMALFORMED")
    summary = _summary(spark, table)
    if summary is None:
        entries = reader.json(f"{table}/log")
    else:
        version, entries = summary
        behind = _behind(spark, f"{table}/log", version)
        if behind:
            entries = entries.unionByName(reader.json(behind))
    whole = F.col("version").isNotNull() & F.col("added_files").isNotNull()
    return entries.filter(whole).orderBy("version")


def _entry(spark: SparkSession, table: str, version: int | None) -> Row | None:
    """The log entry of a version, by default the newest; None where there is none."""
    if not exists(spark, f"{table}/log"):
        return None
    log = history(spark, table)
    if version is not None:
        log = log.filter(F.col("version") == version)
    return log.orderBy(F.desc("version")).first()


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of ``version``, by default the newest."""
    entry = _entry(spark, table, version)
    if entry is None:
        raise LookupError(f"{table} has no version {version if version is not None else 'at all'}")
    if entry["groups"] is not None:
        return read_groups(spark, table, entry)
    folders = [f"{table}/{folder}" for folder in entry["added_files"]]
    if entry["group_columns"] is None:
        return spark.read.parquet(*folders)
    # folder names carry no types and come last, and a table without rows has no files
    schema = StructType.fromJson(json.loads(entry["group_columns"]))
    return spark.read.schema(schema).parquet(*folders).select(*[F.col("`" + c.replace("`", "``") + "`") for c in schema.names])


def group_changes(spark: SparkSession, table: str, old: int, new: int) -> DataFrame:
    """Groups of two versions side by side, from the log alone: ``name, old_records, new_records, change``.

    ``change`` is added, removed, changed or same; versions of other groupings or schemas share no group.
    """
    log = history(spark, table)

    def groups(version: int, prefix: str) -> DataFrame:
        rows = log.filter(F.col("version") == version).select("grouping", "group_schema", F.explode("groups").alias("g"))
        return rows.select(
            F.struct("grouping", "group_schema", "g.name").alias("key"),
            F.col("g.records").alias(f"{prefix}_records"), F.col("g.digest").alias(f"{prefix}_digest"))

    before, after = groups(old, "old"), groups(new, "new").withColumnRenamed("key", "new_key")
    both = before.join(after, F.col("key").eqNullSafe(F.col("new_key")), "full")
    same = (F.col("old_digest") == F.col("new_digest")) & (F.col("old_records") == F.col("new_records"))
    change = (
        F.when(F.col("key").isNull(), "added").when(F.col("new_key").isNull(), "removed").when(same, "same").otherwise("changed")
    )
    name = F.when(F.col("key").isNotNull(), F.col("key.name")).otherwise(F.col("new_key.name"))
    return both.select(name.alias("name"), "old_records", "new_records", change.alias("change")).orderBy("name")


def _commits(spark: SparkSession, root: str) -> DataFrame:
    reader = spark.read.schema("version bigint, tables map<string,bigint>").option("mode", "DROPMALFORMED")
    return reader.json(f"{root}/commits").filter(F.col("version").isNotNull() & F.col("tables").isNotNull())


def commit_tables(spark: SparkSession, root: str, tables: Mapping[str, int]) -> int:
    """Make the named versions of the tables below ``root`` one state; gives the state's number."""
    return _commit(spark, f"{root}/commits", {"tables": dict(tables)})


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables below ``root`` as the newest commit names them."""
    newest = _commits(spark, root).orderBy(F.desc("version")).first() if exists(spark, f"{root}/commits") else None
    if newest is None:
        raise LookupError(f"{root} has no commit")
    return {name: read_version(spark, f"{root}/{name}", version) for name, version in newest["tables"].items()}


def schema_changes(spark: SparkSession, table: str, old: int, new: int) -> DataFrame:
    """Columns of two versions side by side: ``column, old_type, new_type, change``."""
    log = history(spark, table)

    def columns_of(version: int, name: str) -> DataFrame:
        return log.filter(F.col("version") == version).select(F.explode("schema").alias("column", name))

    both = columns_of(old, "old_type").join(columns_of(new, "new_type"), "column", "full")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "changed")
        .otherwise("same")
    )
    return both.withColumn("change", change).orderBy("column")
