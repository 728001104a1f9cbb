"""The analytic queries over the Gold star.

All dimension joins are plain equi-joins: Spark broadcasts a dimension whose measured size is
below its threshold. The latest period comes from the year dimension as a scalar subquery,
so a last year without facts gives an empty result. The filter is on the year dimension before it meets
the facts: where these are stored by ``year_id``, Spark reads the folders of the years that are left only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.functions.numbers import density, growth_pct
from strata.operators.reshape import register

Gold = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Band:
    """A group of provinces: exact names, or any name containing a fragment."""

    label: str
    names: tuple[str, ...] = ()
    fragments: tuple[str, ...] = ()

    def matches(self, name: Column) -> Column:
        """Whether ``name`` belongs to this band."""
        found = name.isin(*self.names) if self.names else F.lit(False)
        for fragment in self.fragments:
            found = found | name.contains(fragment)
        return found


# Island groups, first match wins.
ISLAND_BANDS = (
    Band("Jawa", ("Jakarta", "DKI Jakarta", "Jawa Barat", "Jawa Tengah", "Yogyakarta", "DI Yogyakarta",
                  "Jawa Timur", "Banten")),
    Band("Sumatera", ("Aceh", "Sumatera Utara", "Sumatera Barat", "Riau", "Jambi", "Sumatera Selatan",
                      "Bengkulu", "Lampung", "Kepulauan Bangka Belitung", "Kepulauan Riau")),
    Band("Kalimantan", fragments=("Kalimantan",)),
    Band("Sulawesi", ("Gorontalo",), ("Sulawesi",)),
    Band("Papua", fragments=("Papua",)),
    Band("Bali & Nusa Tenggara", ("Bali", "Nusa Tenggara Barat", "Nusa Tenggara Timur")),
    Band("Maluku", ("Maluku", "Maluku Utara")),
)
# The remaining labels of the reports, and the names of one island.
OTHER_BAND = "Lainnya"
JAVA_PROVINCES = (
    "Jakarta", "DKI Jakarta", "Jawa Barat", "Jawa Tengah", "Jawa Timur", "Banten", "Yogyakarta",
    "DI Yogyakarta",
)
# Labels of the two sides of the average.
ABOVE, BELOW = "Di Atas Rata-rata", "Di Bawah Rata-rata"

# Sums of published figures are taken in decimal, so they do not depend on the order of rows.
_EXACT = "decimal(28,6)"


def _exact_sum(figure: Column) -> Column:
    return F.sum(figure.cast(_EXACT)).cast("double")


def _exact_avg(figure: Column) -> Column:
    return F.try_divide(_exact_sum(figure), F.count(figure))


def _facts(gold: Gold) -> DataFrame:
    return gold["fact_economics"].join(gold["dim_year"], "year_id")


def _with_province(df: DataFrame, gold: Gold) -> DataFrame:
    return df.join(gold["dim_province"], "province_id")


def _latest_facts(gold: Gold) -> DataFrame:
    """Facts of the last year of the year dimension."""
    years = gold["dim_year"]
    last = years.filter(F.col("year") == years.select(F.max("year")).scalar())
    return gold["fact_economics"].join(last, "year_id")


def register_gold(gold: Gold) -> None:
    """Expose the Gold tables to ``spark.sql`` under their own names."""
    register(dict(gold))


def top_per_capita(gold: Gold, k: int = 5) -> DataFrame:
    """The ``k`` provinces with the highest GDP per head in the latest year."""
    rows = _with_province(_latest_facts(gold).filter(F.col("gdp_per_capita").isNotNull()), gold)
    ranked = rows.orderBy(F.desc_nulls_last("gdp_per_capita"), F.asc_nulls_last("province_name")).limit(k)
    return ranked.select(
        "province_name", "province_name_en", "gdp_current_price", "population",
        F.round("gdp_per_capita", 2).alias("gdp_per_capita_juta"), "area_km2",
    )


def band_averages(gold: Gold, bands: Sequence[Band] = ISLAND_BANDS, other: str = OTHER_BAND) -> DataFrame:
    """Averages of the latest year per band of provinces, richest band first."""
    rows = _with_province(_latest_facts(gold), gold)
    label = F.lit(other)
    for band in reversed(bands):
        label = F.when(band.matches(F.col("province_name")), F.lit(band.label)).otherwise(label)
    return rows.groupBy(label.alias("island_group")).agg(
        F.count(F.lit(1)).alias("province_count"),
        F.round(_exact_avg(F.col("gdp_current_price")), 2).alias("avg_gdp_miliar"),
        F.sum("population").alias("total_population"),
        F.round(F.avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
    ).orderBy(F.desc_nulls_last("avg_gdp_miliar"))


def yoy_growth(gold: Gold, provinces: Sequence[str] = JAVA_PROVINCES) -> DataFrame:
    """GDP against the previous year for the listed provinces.

    The names are filtered first. A window partition holds the years of one province, so the
    calendar bounds it.
    """
    rows = _with_province(_facts(gold), gold).filter(F.col("province_name").isin(*provinces))
    by_year = Window.partitionBy("province_name").orderBy("year")
    rows = rows.withColumn("prev_year_gdp", F.lag("gdp_current_price").over(by_year))
    growth = growth_pct(F.col("gdp_current_price"), F.col("prev_year_gdp"))
    return rows.select(
        "province_name", "year", "gdp_current_price", "prev_year_gdp",
        F.round(growth, 2).alias("growth_rate_pct"),
    ).orderBy(F.asc_nulls_last("province_name"), F.asc_nulls_last("year"))


def national_trend(gold: Gold) -> DataFrame:
    """Totals per year over the provinces that have a head count."""
    return _facts(gold).filter(F.col("population") > 0).groupBy("year").agg(
        F.sum("population").alias("total_national_population"),
        F.count_distinct("province_id").alias("province_count"),
        F.round(F.avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
        F.round(_exact_sum(F.col("gdp_current_price")), 2).alias("total_national_gdp"),
    ).orderBy(F.asc_nulls_last("year"))


def above_below_average(gold: Gold) -> DataFrame:
    """Provinces of the latest year split at the mean GDP per head."""
    rows = _latest_facts(gold).filter(F.col("gdp_per_capita").isNotNull())
    mean = rows.agg(F.avg("gdp_per_capita").alias("mean"))
    split = rows.crossJoin(F.broadcast(mean))  # one row
    kind = F.when(F.col("gdp_per_capita") >= F.col("mean"), F.lit(ABOVE)).otherwise(F.lit(BELOW))
    return split.groupBy(kind.alias("kategori")).agg(
        F.count(F.lit(1)).alias("jumlah_provinsi"),
        F.round(F.avg("gdp_per_capita"), 2).alias("avg_gdp_per_capita"),
        F.round(F.min("gdp_per_capita"), 2).alias("min_gdp_per_capita"),
        F.round(F.max("gdp_per_capita"), 2).alias("max_gdp_per_capita"),
        F.sum("population").alias("total_populasi"),
    )


def density_ranking(gold: Gold, k: int = 10) -> DataFrame:
    """The ``k`` most densely peopled provinces of the latest year; names break ties."""
    rows = _with_province(_latest_facts(gold), gold).filter(
        (F.col("area_km2") > 0) & (F.col("population") > 0)
    )
    return rows.select(
        "province_name", "population", "area_km2",
        F.round(density(F.col("population"), F.col("area_km2")), 2).alias("population_density"),
        F.round("gdp_per_capita", 2).alias("gdp_per_capita_juta"),
        F.col("gdp_current_price").alias("total_gdp_miliar"),
    ).orderBy(F.desc_nulls_last("population_density"), F.asc_nulls_last("province_name")).limit(k)


def selective_star(gold: Gold, provinces: Sequence[str], year: int) -> DataFrame:
    """GDP of the listed provinces in one year; both filters reach the dimension scans."""
    rows = _with_province(_facts(gold), gold)
    return rows.filter(F.col("province_name").isin(*provinces) & (F.col("year") == year)).select(
        "province_name", "year", "gdp_current_price"
    )
