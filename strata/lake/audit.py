"""Run metadata: audit columns on rows, one manifest per run."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.periods import run_clock
from strata.operators.clean import AUDIT_COLUMNS
from strata.sources.objects import exists, write_text

log = logging.getLogger(__name__)

# The fields of a manifest.
MANIFEST_SCHEMA = (
    "ingestion_timestamp string, source_name string, source_url string, api_version string, "
    "operator_id string, record_count bigint, data_format string"
)

MANIFEST_FIELDS = tuple(field.split()[0] for field in MANIFEST_SCHEMA.split(", "))


def run_metadata(
    source_name: str, source_url: str, api_version: str, operator_id: str, record_count: int,
    data_format: str, extra: Mapping[str, Any] | None = None, clock: datetime | None = None,
) -> dict[str, Any]:
    """The fields of one run; ``extra`` adds fields and may replace the standard ones."""
    moment = (clock or run_clock()).isoformat()
    values = (moment, source_name, source_url, api_version, operator_id, record_count, data_format)
    return {**dict(zip(MANIFEST_FIELDS, values)), **(extra or {})}


def with_audit(df: DataFrame, metadata: Mapping[str, Any]) -> DataFrame:
    """Append the audit columns as constants; one that the metadata lacks is left out."""
    for name in AUDIT_COLUMNS:
        if name not in metadata:
            log.warning("no %s in the metadata, column left out", name)
    return df.withColumns({c: F.lit(metadata[c]) for c in AUDIT_COLUMNS if c in metadata})


def save_manifest(spark: SparkSession, path: str, metadata: Mapping[str, Any]) -> None:
    """Store the metadata as one JSON line; an existing manifest is never replaced."""
    write_text(spark, path, json.dumps(dict(metadata), ensure_ascii=False, default=str), exclusive=True)


def read_manifests(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """One manifest, or all manifests of a folder as a table; ``extra`` names more fields."""
    schema = f"{MANIFEST_SCHEMA}, {extra}" if extra else MANIFEST_SCHEMA
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
