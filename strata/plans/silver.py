"""Silver tables: typed, conformed, one projection over the landed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numbers import to_double, to_long, whole
from strata.functions.text import conform_exact
from strata.operators.clean import (
    clean_strings, convert_existing, drop_audit, keep_first, locale_numbers, rejected,
)

# Landed columns and their Silver names.
GDP_COLUMNS = {
    "kode_provinsi": "province_code",
    "nama_provinsi": "province_name",
    "tahun": "year",
    "pdrb_harga_berlaku": "gdp_current_price",
    "pdrb_harga_konstan": "gdp_constant_price",
}
POPULATION_COLUMNS = {
    "kode_provinsi": "province_code",
    "nama_provinsi": "province_name",
    "tahun": "year",
    "jumlah_penduduk": "population",
}


def clean_entities(landed: DataFrame) -> DataFrame:
    """Entities by id. Of several rows of one id the first in source order stays.

    The source sorts by iso code with missing codes first; the other columns break ties, so
    the choice does not depend on how the rows are distributed.
    """
    df = clean_strings(drop_audit(landed))
    df = convert_existing(df, {
        "population": to_long, "area_km2": to_double, "latitude": to_double, "longitude": to_double,
    })
    if "wikidata_qid" not in df.columns:
        return df
    lead = [c for c in ("iso_code",) if c in df.columns]
    rest = [c for c in df.columns if c not in (*lead, "wikidata_qid")]
    order = [F.col(c).asc_nulls_first() for c in lead] + [F.col(c).asc_nulls_last() for c in rest]
    return keep_first(df, ["wikidata_qid"], order or [F.col("wikidata_qid")])


def _statistics(landed: DataFrame, figures: list[str], fmt: str) -> DataFrame:
    df = drop_audit(landed)
    # The format rule looks at the cells as scanned; null words count as missing.
    df = locale_numbers(clean_strings(df), figures, fmt)
    df = convert_existing(df, {"nama_provinsi": conform_exact})
    df = df.withColumns({c: to_long(F.col(c)) for c in ("kode_provinsi", "tahun")})
    return df.drop("satuan")


def clean_gdp(landed: DataFrame, fmt: str = "auto") -> DataFrame:
    """GDP per region and year."""
    df = _statistics(landed, ["pdrb_harga_berlaku", "pdrb_harga_konstan"], fmt)
    return df.withColumnsRenamed(GDP_COLUMNS)


def clean_population(landed: DataFrame, fmt: str = "auto") -> DataFrame:
    """Head count per region and year; a fractional head count becomes null."""
    df = _statistics(landed, ["jumlah_penduduk"], fmt)
    df = convert_existing(df, {"jumlah_penduduk": whole})
    return df.withColumnsRenamed(POPULATION_COLUMNS)


def rejected_population(landed: DataFrame, fmt: str = "auto") -> DataFrame:
    """One row ``rejected``: landed head counts that Silver turns into null."""
    cells = clean_strings(landed.select("jumlah_penduduk"))
    cells = cells.withColumn("before", F.col("jumlah_penduduk"))
    cells = locale_numbers(cells, ["jumlah_penduduk"], fmt)
    return cells.agg(rejected(F.col("before"), whole(F.col("jumlah_penduduk"))).alias("rejected"))
