"""Idempotent landing: unchanged data is not written again.

A load writes the batch, then its manifest, then the digest. Readers find the newest batch
through the manifests, so a batch that a crash left without one is never seen, and since
the digest comes last, the interrupted load is simply repeated.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions.periods import run_clock
from strata.lake.audit import read_manifests, run_metadata, save_manifest, with_audit
from strata.lake.digest import table_digest
from strata.lake.groups import GROUPING_SCHEMA, Group, Grouping, groups_of, known_groups, read_groups, store_groups
from strata.operators.clean import AUDIT_COLUMNS
from strata.sources.files import read_csv, write_csv, write_parquet
from strata.sources.objects import read_text, write_text

LOADED, UNCHANGED, EMPTY = "loaded", "unchanged", "empty"


class EmptyBatch(ValueError):
    """A source delivered no rows; landing them would wipe good data."""


@dataclass(frozen=True)
class LoadResult:
    """What a load did; ``batch`` is set where it wrote one."""

    status: str
    records: int
    digest: str
    batch: str | None = None
    groups: tuple[str | None, ...] = ()  # what was stored, where the load was by groups


def _checksum_path(root: str) -> str:
    return f"{root}/checksum/latest.md5"


def _manifest_dir(root: str) -> str:
    return f"{root}/manifests"


def batch_path(root: str, batch: str) -> str:
    """Folder of one batch."""
    return f"{root}/batches/batch_ts={batch}"


def stored_digest(spark: SparkSession, root: str) -> str | None:
    """Digest of the last completed load, or None."""
    text = read_text(spark, _checksum_path(root))
    return text.strip() if text is not None else None


def has_changed(spark: SparkSession, root: str, digest: str) -> bool:
    """Whether ``digest`` differs from the stored one; no stored digest means changed."""
    return stored_digest(spark, root) != digest


def ingest_if_changed(
    df: DataFrame, root: str, source: Mapping[str, str], fmt: str = "parquet", on_empty: str = "raise",
    clock: datetime | None = None, extra: Mapping[str, Any] | None = None,
) -> LoadResult:
    """Land ``df`` below ``root`` unless its digest equals that of the last load.

    ``source`` gives source_name, source_url, api_version and operator_id. Parquet keeps types and
    any text; CSV keeps text with line breaks, but cells that are null words read as null.

    The digest is taken before audit columns are added, in a pass of its own: an unchanged source
    is read and nothing is written. Should the source change between that pass and the write, the
    stored digest is the older one and the next run loads again. The manifest's count is that
    of the stored files. ``df`` is read twice; store an expensive one first.
    """
    if on_empty not in ("raise", "skip"):
        raise ValueError(f"unknown empty-batch policy {on_empty!r}")
    spark = df.sparkSession
    clock = clock or run_clock()
    before = table_digest(df).first()
    if before["records"] == 0:
        if on_empty == "raise":
            raise EmptyBatch(f"no rows for {root}")
        return LoadResult(EMPTY, 0, before["digest"])
    if not has_changed(spark, root, before["digest"]):
        return LoadResult(UNCHANGED, before["records"], before["digest"])

    batch = clock.strftime("%Y%m%d_%H%M%S_%f")
    audit = run_metadata(**source, record_count=before["records"], data_format=fmt, clock=clock)
    write = {"csv": write_csv, "parquet": write_parquet}[fmt]
    write(with_audit(df, audit), batch_path(root, batch))

    records = _read_batch(spark, root, batch, fmt).count()
    manifest = run_metadata(
        **source, record_count=records, data_format=fmt, clock=clock,
        extra={**(extra or {}), "batch": batch, "digest": before["digest"]},
    )
    save_manifest(spark, f"{_manifest_dir(root)}/manifest_{batch}.json", manifest)
    write_text(spark, _checksum_path(root), before["digest"])
    return LoadResult(LOADED, records, before["digest"], batch)


def ingest_changed_groups(
    df: DataFrame, root: str, source: Mapping[str, str], grouping: Grouping, absent: str = "keep", on_empty: str = "raise",
    clock: datetime | None = None, extra: Mapping[str, Any] | None = None,
) -> LoadResult:
    """Land the groups of ``df`` that differ from the landed ones, as Parquet.

    A delivery may hold some groups only, one period say: the others stay (``absent="keep"``), or are dropped
    (``"drop"``) where ``df`` is everything. The manifest names the folder of every group, so the files
    of unchanged groups stay where they are and keep the audit columns of the load that brought them.
    Otherwise as :func:`ingest_if_changed`.
    """
    if on_empty not in ("raise", "skip"):
        raise ValueError(f"unknown empty-batch policy {on_empty!r}")
    spark = df.sparkSession
    clock = clock or run_clock()
    if df.isEmpty():
        if on_empty == "raise":
            raise EmptyBatch(f"no rows for {root}")
        return LoadResult(EMPTY, 0, table_digest(df).first()["digest"])
    batch = clock.strftime("%Y%m%d_%H%M%S_%f")
    audit = {c: F.lit(v) for c, v in run_metadata(**source, record_count=0, data_format="parquet", clock=clock).items() if c in AUDIT_COLUMNS}
    newest = _newest(spark, root)
    stored = store_groups(df, root, f"batches/batch_ts={batch}", grouping, known_groups(newest, grouping, df), absent, audit)
    if not stored.written and not stored.dropped and newest is not None:
        return LoadResult(UNCHANGED, stored.records, stored.checksum)
    manifest = run_metadata(
        **source, record_count=stored.records, data_format="parquet", clock=clock,
        extra={**(extra or {}), "batch": batch, "digest": stored.checksum, **stored.entry()},
    )
    save_manifest(spark, f"{_manifest_dir(root)}/manifest_{batch}.json", manifest)
    write_text(spark, _checksum_path(root), stored.checksum)
    return LoadResult(LOADED, stored.records, stored.checksum, batch, tuple(group.name for group in stored.written))


def landed_groups(spark: SparkSession, root: str) -> tuple[Group, ...]:
    """The groups of the newest load; none where it was not by groups."""
    newest = _newest(spark, root)
    return () if newest is None or newest["groups"] is None else groups_of(newest)


def load_history(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of all completed loads."""
    return read_manifests(spark, _manifest_dir(root), "batch string, digest string")


def _newest(spark: SparkSession, root: str) -> Row | None:
    """The manifest of the newest load that wrote anything."""
    try:
        manifests = read_manifests(spark, _manifest_dir(root), f"batch string, digest string, {GROUPING_SCHEMA}")
    except FileNotFoundError:
        return None
    return manifests.orderBy(F.desc("batch")).first()


def latest_batch(spark: SparkSession, root: str) -> str | None:
    """Name of the newest batch that has a manifest."""
    try:
        return load_history(spark, root).agg(F.max("batch")).first()[0]
    except FileNotFoundError:
        return None


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the newest landed batch, or of all groups as the newest load by groups names them."""
    newest = _newest(spark, root)
    if newest is None or newest["batch"] is None:
        raise FileNotFoundError(root)
    if newest["groups"] is not None:
        return read_groups(spark, root, newest)
    return _read_batch(spark, root, newest["batch"], newest["data_format"])


def _read_batch(spark: SparkSession, root: str, batch: str, fmt: str) -> DataFrame:
    path = batch_path(root, batch)
    return spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path, escaped=True)
