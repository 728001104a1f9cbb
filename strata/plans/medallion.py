"""The whole flow: landed responses to Bronze batches to versioned Silver to Gold on disk."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.lake.groups import by_value
from strata.lake.ingest import LoadResult, ingest_changed_groups, ingest_if_changed, landed_groups, read_latest
from strata.lake.versions import commit_tables, read_tables, read_version, write_version
from strata.operators.joins import NAME_ALIASES
from strata.operators.reshape import pivot_mean
from strata.plans.gold import build_gold
from strata.plans.silver import clean_entities, clean_gdp, clean_population
from strata.sources.files import first_usable, read_csv
from strata.sources.objects import exists
from strata.sources.responses import (
    BINDING_COLUMNS, BINDINGS_SCHEMA, CUBE_MEASURES, CUBE_SCHEMA, TABLE_SERVICE_SCHEMA,
    flatten_bindings, flatten_cube, flatten_table_service, missing_periods, read_responses,
)
from strata.workspace import clear_scratch, materialize

# The datasets and their folders in each layer.
BRONZE = {
    "wikidata_provinces": "bronze/wikidata/provinces",
    "bps_pdrb": "bronze/bps/pdrb",
    "bps_populasi": "bronze/bps/populasi",
}
CLEANERS = {"wikidata_provinces": clean_entities, "bps_pdrb": clean_gdp, "bps_populasi": clean_population}
SOURCES = {
    "wikidata_provinces": {
        "source_name": "WikiData", "source_url": "https://query.wikidata.org/sparql", "api_version": "sparql_v1",
    },
    "bps_pdrb": {"source_name": "BPS_PDRB_API", "source_url": "webapi.bps.go.id", "api_version": "v1"},
    "bps_populasi": {"source_name": "BPS_SIMDASI_API", "source_url": "webapi.bps.go.id", "api_version": "v1"},
}
OPERATOR = "pipeline_auto"
YEARS = (2019, 2020, 2021, 2022, 2023)
GOLD_TABLES = ("dim_province", "dim_year", "dim_indicator", "fact_economics")
UNMATCHED = "unmatched"
PARTITIONS = {"fact_economics": ("year_id",)}  # columns whose values have a folder each


class MissingPeriods(ValueError):
    """Some expected years brought no rows; landing the rest would replace a full batch."""


def entity_batch(
    spark: SparkSession, responses: str, fallback: str | None = None, one_per_file: bool = True,
    fallback_options: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Entity rows of the landed graph results, stored.

    With a ``fallback`` those of that CSV, where the results are absent, unreadable or without rows. Its
    columns are bound by header; ``fallback_options`` go to ``read_csv``: ``multiline`` for cells with line
    breaks, ``escaped`` for files of ``write_csv``.
    """
    def primary() -> DataFrame | None:
        if fallback is not None and not exists(spark, responses):
            return None
        found = flatten_bindings(read_responses(spark, responses, BINDINGS_SCHEMA, one_per_file))
        return materialize(found, "entities")

    if fallback is None:
        return primary()
    found = first_usable(primary)
    return found if found is not None else read_csv(
        spark, fallback, list(BINDING_COLUMNS.values()), **(fallback_options or {}))


def gdp_cells(spark: SparkSession, responses: str, one_per_file: bool = True) -> DataFrame:
    """Cells of the landed cubes."""
    return flatten_cube(read_responses(spark, responses, CUBE_SCHEMA, one_per_file))


def gdp_batch(cells: DataFrame) -> DataFrame:
    """Regional GDP of cube cells, one row per region and year; other measures are left out."""
    return pivot_mean(cells, ["kode_provinsi", "nama_provinsi", "tahun"], "turvar", "nilai", CUBE_MEASURES)


def population_batch(spark: SparkSession, responses: str, one_per_file: bool = True) -> DataFrame:
    """Regional population of the landed table-service payloads."""
    return flatten_table_service(read_responses(spark, responses, TABLE_SERVICE_SCHEMA, one_per_file))


def land_periods(
    rows: DataFrame, root: str, source: Mapping[str, str], expected: Sequence[int], period: str = "tahun",
    clock: datetime | None = None, extra: Mapping[str, object] | None = None,
) -> LoadResult:
    """Land a statistic by period: each period that differs replaces its own partition and no other.

    ``rows`` may hold some periods only. Periods of ``expected`` that are neither in it nor landed before
    are refused.
    """
    spark = rows.sparkSession
    landed = {group.name for group in landed_groups(spark, root)}
    missing = [r[0] for r in missing_periods(rows, period, list(expected)).collect() if str(r[0]) not in landed]
    if missing:
        raise MissingPeriods(f"{root} lacks {sorted(missing)}")
    return ingest_changed_groups(rows, root, source, by_value(period), on_empty="skip", clock=clock, extra=extra)


def land(
    spark: SparkSession, raw: str, root: str, years: Sequence[int] = YEARS, fallback: str | None = None,
    one_per_file: bool = True, fallback_options: Mapping[str, bool] | None = None, by_period: bool = False,
) -> dict[str, LoadResult]:
    """Bring the responses below ``raw`` into Bronze, each dataset only if it changed.

    ``raw`` holds ``wikidata_provinces/``, ``bps_pdrb/th=119/`` and ``bps_populasi/tahun=2019/``,
    with one response per file, or else one per line, which Spark can split. No entities is an
    error, an empty statistic is skipped, and a statistic that lacks one of ``years`` is refused.
    So is any dataset with a response that cannot be read, but for entities with a ``fallback``;
    ``rejected_responses`` shows it. The manifest of the GDP counts the cells of other measures.

    With ``by_period`` a statistic's years are landed each on its own: ``raw`` may then hold the responses of
    some years only, which replace those years and leave the others' files as they are.
    """
    cells = materialize(gdp_cells(spark, f"{raw}/bps_pdrb", one_per_file), "cells")
    others = cells.filter(~F.col("turvar").isin(*CUBE_MEASURES)).count()
    batches = {
        "wikidata_provinces": entity_batch(spark, f"{raw}/wikidata_provinces", fallback, one_per_file, fallback_options),
        "bps_pdrb": gdp_batch(cells),
        "bps_populasi": population_batch(spark, f"{raw}/bps_populasi", one_per_file),
    }
    extras = {"bps_pdrb": {"cells_of_other_measures": others}}
    results = {}
    for name, batch in batches.items():
        rows = materialize(batch, name)  # parsed once, read to compare and to write
        statistic = "tahun" in rows.columns
        if statistic and by_period:
            results[name] = land_periods(
                rows, f"{root}/{BRONZE[name]}", {**SOURCES[name], "operator_id": OPERATOR}, years, extra=extras.get(name))
            continue
        if statistic and not rows.isEmpty():
            missing = [r[0] for r in missing_periods(rows, "tahun", list(years)).collect()]
            if missing:
                raise MissingPeriods(f"{name} lacks {sorted(missing)}")
        results[name] = ingest_if_changed(
            rows, f"{root}/{BRONZE[name]}", {**SOURCES[name], "operator_id": OPERATOR},
            on_empty="skip" if statistic else "raise", extra=extras.get(name),
        )
    return results


def refresh_silver(spark: SparkSession, root: str) -> None:
    """Clean the newest batch of each dataset into the next version of its Silver table."""
    for name, clean in CLEANERS.items():
        write_version(clean(read_latest(spark, f"{root}/{BRONZE[name]}")), f"{root}/silver/{name}")


def refresh_gold(spark: SparkSession, root: str, aliases: Mapping[str, list[str]] = NAME_ALIASES) -> DataFrame:
    """Rebuild Gold from the newest Silver versions; returns the names that did not resolve.

    Each table gets a new version, the facts with a folder a year; one commit then makes them the state that
    readers see.
    """
    silver = [read_version(spark, f"{root}/silver/{name}") for name in CLEANERS]
    gold = build_gold(*silver, dict(aliases))
    written = {
        name: write_version(gold[name], f"{root}/gold/{name}", partition_by=PARTITIONS.get(name, ())).version
        for name in (*GOLD_TABLES, UNMATCHED)
    }
    commit_tables(spark, f"{root}/gold", written)
    return read_tables(spark, f"{root}/gold")[UNMATCHED]


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The Gold tables of the newest commit."""
    stored = read_tables(spark, f"{root}/gold")
    return {name: stored[name] for name in GOLD_TABLES}


def run_flow(
    spark: SparkSession, raw: str, root: str, years: Sequence[int] = YEARS, fallback: str | None = None,
    one_per_file: bool = True, aliases: Mapping[str, list[str]] = NAME_ALIASES,
    fallback_options: Mapping[str, bool] | None = None,
) -> dict[str, LoadResult]:
    """Landing, Silver and Gold, and then the removal of what the application stored on the way."""
    results = land(spark, raw, root, years, fallback, one_per_file, fallback_options)
    refresh_silver(spark, root)
    refresh_gold(spark, root, aliases)
    clear_scratch(spark)
    return results
