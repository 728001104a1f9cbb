"""Gold star: entity, year and indicator dimensions and the economics fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numbers import per_capita
from strata.functions.periods import decade, is_census_year
from strata.functions.text import match_key
from strata.operators.clean import select_existing
from strata.operators.joins import (
    NAME_ALIASES, alias_lookup, key_lookup, outer_merge, resolve_names, unmatched,
)
from strata.operators.keys import dense_key
from strata.operators.reshape import distinct_values
from strata.sources.files import literal_table

# Entity attributes kept in Gold.
ENTITY_COLUMNS = (
    "province_name_id", "province_name_en", "iso_code", "capital_city", "area_km2", "latitude",
    "longitude", "inception_date", "wikidata_qid",
)

# The indicators.
INDICATORS = (
    (1, "GDP Current Price", "economic", "Miliar Rupiah", "Produk Domestik Regional Bruto Atas Dasar Harga Berlaku"),
    (2, "GDP Constant Price", "economic", "Miliar Rupiah", "Produk Domestik Regional Bruto Atas Dasar Harga Konstan"),
    (3, "Population", "demographic", "Jiwa", "Jumlah Penduduk"),
)
INDICATOR_SCHEMA = T.StructType([
    T.StructField("indicator_id", T.LongType(), False),
    *[T.StructField(c, T.StringType()) for c in ("indicator_name", "indicator_type", "unit", "description")],
])

# Measures of the fact, as far as the inputs have them.
FACT_COLUMNS = (
    "province_id", "year_id", "gdp_current_price", "gdp_constant_price", "population", "gdp_per_capita",
)
MERGE_KEYS = ("province_name", "year")


def build_dim_province(entities: DataFrame) -> DataFrame:
    """Entities with an iso code, numbered in iso order, with two columns to match names on."""
    dim = select_existing(entities, ENTITY_COLUMNS).withColumnRenamed("province_name_id", "province_name")
    if "iso_code" in dim.columns:
        dim = dim.filter(F.col("iso_code").isNotNull())
    lead = [c for c in ("iso_code", "wikidata_qid") if c in dim.columns]
    keyed = dense_key(dim, "province_id", [*lead, *[c for c in dim.columns if c not in lead]])
    for source, key in (("province_name", "province_name_match"), ("province_name_en", "province_name_en_match")):
        name = F.col(source) if source in keyed.columns else F.lit(None).cast("string")
        keyed = keyed.withColumn(key, match_key(name))
    return keyed


def build_dim_year(*statistics: DataFrame) -> DataFrame:
    """The years of all inputs with decade and census flag."""
    years = distinct_values("year", *statistics)
    return dense_key(years, "year_id", ["year"]).select(
        "year_id", "year", decade(F.col("year")).alias("decade"),
        is_census_year(F.col("year")).alias("is_census_year"),
    )


def build_dim_indicator(spark: SparkSession) -> DataFrame:
    """The literal indicator table."""
    return literal_table(spark, INDICATORS, INDICATOR_SCHEMA)


def merge_statistics(gdp: DataFrame, population: DataFrame) -> DataFrame:
    """Both statistics by name and year; a side that lacks a pair has nulls."""
    return outer_merge(gdp, population.select(*MERGE_KEYS, "population"), MERGE_KEYS)


def name_lookup(dim_province: DataFrame, aliases: dict[str, list[str]] = NAME_ALIASES) -> DataFrame:
    """Match name to province_id over local and English names and aliases."""
    return alias_lookup(dim_province, "province_id", ["province_name_match", "province_name_en_match"], aliases)


def build_fact(merged: DataFrame, dim_province: DataFrame, dim_year: DataFrame,
               aliases: dict[str, list[str]] = NAME_ALIASES) -> DataFrame:
    """Facts whose name and year resolve, with GDP per head, numbered by name and year."""
    keyed = resolve_names(merged, name_lookup(dim_province, aliases), "province_name", "province_id")
    keyed = key_lookup(keyed, dim_year, "year", "year_id").na.drop(subset=["province_id", "year_id"])
    rated = keyed.withColumn("gdp_per_capita", per_capita(F.col("gdp_current_price"), F.col("population")))
    facts = rated.select(*MERGE_KEYS, *[c for c in FACT_COLUMNS if c in rated.columns])
    ties = [c for c in facts.columns if c not in MERGE_KEYS]
    return dense_key(facts, "economics_id", [*MERGE_KEYS, *ties]).drop(*MERGE_KEYS)


def build_gold(entities: DataFrame, gdp: DataFrame, population: DataFrame,
               aliases: dict[str, list[str]] = NAME_ALIASES) -> dict[str, DataFrame]:
    """The four Gold tables, and the names that did not resolve under ``unmatched``."""
    dim_province = build_dim_province(entities)
    dim_year = build_dim_year(gdp, population)
    names = distinct_values("province_name", gdp, population)
    return {
        "dim_province": dim_province,
        "dim_year": dim_year,
        "dim_indicator": build_dim_indicator(entities.sparkSession),
        "fact_economics": build_fact(merge_statistics(gdp, population), dim_province, dim_year, aliases),
        "unmatched": unmatched(names, name_lookup(dim_province, aliases), "province_name"),
    }


def gold_summary(gold: dict[str, DataFrame]) -> DataFrame:
    """Rows per Gold table and the number of names that did not resolve."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
