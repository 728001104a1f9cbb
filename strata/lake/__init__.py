"""Landing, auditing, versioning and measuring stored tables."""

from strata.lake.audit import read_manifests, run_metadata, save_manifest, with_audit
from strata.lake.digest import digest_aggregates, row_md5, schema_map, seal, table_digest
from strata.lake.footprint import footprint
from strata.lake.groups import Group, Grouping, by_hash, by_value, group_digests
from strata.lake.ingest import (
    EmptyBatch, LoadResult, batch_path, has_changed, ingest_changed_groups, ingest_if_changed, landed_groups, latest_batch,
    load_history, read_latest, stored_digest,
)
from strata.lake.profiles import ColumnProfile, merged_profile, read_numbers, write_profiled
from strata.lake.triples import TripleStore, open_triples, stored_optionals, write_triples
from strata.lake.versions import (
    Version, current_version, group_changes, history, read_version, schema_changes, write_groups, write_version,
)

__all__ = [
    "ColumnProfile", "EmptyBatch", "Group", "Grouping", "LoadResult", "TripleStore", "Version", "batch_path", "by_hash", "by_value",
    "current_version", "digest_aggregates", "footprint", "group_changes", "group_digests", "has_changed",
    "history", "ingest_changed_groups", "ingest_if_changed", "landed_groups", "latest_batch",
    "load_history", "merged_profile", "open_triples", "read_latest", "read_manifests", "read_numbers", "read_version", "row_md5", "run_metadata",
    "save_manifest", "schema_changes", "schema_map", "seal", "stored_digest",
    "stored_optionals", "table_digest", "with_audit", "write_groups", "write_profiled",
    "write_triples", "write_version",
]
