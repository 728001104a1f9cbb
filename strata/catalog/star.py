"""Registered queries on the star: the Gold tables and the analytic queries.

The given tables stand in for the published statistics. Nations are the provinces, order totals by
customer nation their GDP, and shipped line items by supplier nation their population. As in
the real data, one entity has no iso code, four regions lack the population of the last year,
the GDP series starts a year late, and two regions are published under other names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.lake.versions import read_version, write_version
from strata.plans import analytics as A
from strata.plans.gold import build_gold, gold_summary
from strata.plans.medallion import PARTITIONS
from strata.workspace import materialize, scratch_path

NO_ISO = "NATION_12"
GAP_YEAR = 2001
GAP_NAMES = ("NATION_3", "NATION_10", "NATION_17", "NATION_24")
GDP_START = "1996-01-01"
PUBLISHED_NAMES = {"NATION_5": "Fifth Nation", "NATION_7": " Republic of Seven\t"}
ALIASES = {
    "fifth nation": ["nation five", "nation_5", "province 6"],
    "republic of seven": ["province 7", "nation_8"],
}
BANDS = (
    A.Band("Low", ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4")),
    A.Band("Teens", fragments=("NATION_1",)),
    A.Band("Mixed", ("NATION_9",), ("NATION_2",)),
)
GROWTH_NAMES = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_10")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _published(name):
    for original, published in PUBLISHED_NAMES.items():
        name = F.when(F.col("n_name") == original, F.lit(published)).otherwise(name)
    return name


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as Silver entities; the area is the summed supplier balance."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    area = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double").alias("area_km2")
    )
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(
        area, F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    code = F.concat(F.lit("XX-"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return rows.select(
        F.col("n_name").alias("province_name_id"),
        F.concat(F.lit("Province "), F.col("n_nationkey").cast("string")).alias("province_name_en"),
        F.when(F.col("n_name") != NO_ISO, code).alias("iso_code"),
        F.col("r_name").alias("capital_city"),
        "area_km2",
        F.col("n_regionkey").cast("double").alias("latitude"),
        F.col("n_nationkey").cast("double").alias("longitude"),
        F.concat(F.lit("19"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("-01-01")).alias("inception_date"),
        F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("wikidata_qid"),
    )


def gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals per nation and year.

    The start is a range on the date itself, so that it reaches the scan. Orders are summed per
    customer and year before they meet the customers, so a customer with very many orders is a
    few rows by the time of the join.
    """
    price = F.col("o_totalprice").cast("decimal(18,2)")
    year = F.year("o_orderdate").cast("bigint")
    per_customer = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") >= F.lit(GDP_START).cast("timestamp_ntz"))
        .groupBy("o_custkey", year.alias("year")).agg(
            F.sum(price).alias("total"),
            F.sum(F.when(F.col("o_orderstatus") == "F", price)).alias("settled"),
        )
    )
    nations = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "n_nationkey", "n_name")
    rows = per_customer.join(nations, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("n_nationkey", "n_name", "year").agg(
        F.sum("total").cast("double").alias("gdp_current_price"),
        F.sum("settled").cast("double").alias("gdp_constant_price"),
    ).select(
        F.col("n_nationkey").cast("bigint").alias("province_code"),
        _published(F.col("n_name")).alias("province_name"),
        "year", "gdp_current_price", "gdp_constant_price",
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per supplier nation and ship year, counted per supplier before the join."""
    per_supplier = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.year("l_shipdate").cast("bigint").alias("year")
    ).agg(F.count(F.lit(1)).alias("items"))
    nations = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "n_nationkey", "n_name")
    rows = per_supplier.join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
    published = rows.filter(~((F.col("year") == GAP_YEAR) & F.col("n_name").isin(*GAP_NAMES)))
    return published.groupBy("n_nationkey", "n_name", "year").agg(F.sum("items").alias("population")).select(
        F.col("n_nationkey").cast("bigint").alias("province_code"),
        _published(F.col("n_name")).alias("province_name"),
        "year", "population",
    )


_GOLD: dict[tuple[str, str], dict[str, DataFrame]] = {}


def gold_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Gold tables over ``sf_dir``, built once per application; their keyed rows are stored.

    The statistics are reduced to (name, year) and stored first: orders and line items are
    scanned once however many Gold tables derive from them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GOLD:
        gold = build_gold(
            entities(spark, sf_dir),
            materialize(gdp(spark, sf_dir), "gdp"),
            materialize(population(spark, sf_dir), "population"),
            ALIASES,
        )
        _GOLD[key] = gold
    return _GOLD[key]


def stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The Gold tables as stored versions, the facts by year."""
    root, gold = scratch_path(spark, "star"), gold_star(spark, sf_dir)
    for name in ("dim_province", "dim_year", "fact_economics"):
        write_version(gold[name], f"{root}/{name}", partition_by=PARTITIONS.get(name, ()))
    return {name: read_version(spark, f"{root}/{name}") for name in ("dim_province", "dim_year", "fact_economics")}


def pruned_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density ranking of the latest year on stored tables; of the facts that year's folder is read only."""
    return A.density_ranking(stored_star(spark, sf_dir))


def _on_gold(build):
    return lambda spark, sf_dir: build(gold_star(spark, sf_dir))


# The same star for the oracle, written as one chain of common table expressions.
STAR = """
WITH area AS (
  SELECT s_nationkey, CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS area_km2
  FROM supplier GROUP BY s_nationkey
), entity AS (
  SELECT n_nationkey, n_name AS province_name, 'Province ' || n_nationkey AS province_name_en,
         CASE WHEN n_name <> 'NATION_12' THEN 'XX-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS iso_code,
         r_name AS capital_city, area_km2, CAST(n_regionkey AS DOUBLE) AS latitude,
         CAST(n_nationkey AS DOUBLE) AS longitude,
         '19' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '-01-01' AS inception_date,
         'Q' || n_nationkey AS wikidata_qid
  FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN area ON n_nationkey = s_nationkey
), dim_province AS (
  SELECT CAST(row_number() OVER (ORDER BY iso_code, wikidata_qid) AS BIGINT) AS province_id,
         province_name, province_name_en, iso_code, capital_city, area_km2, latitude, longitude,
         inception_date, wikidata_qid, lower(province_name) AS province_name_match,
         lower(province_name_en) AS province_name_en_match
  FROM entity WHERE iso_code IS NOT NULL
), published AS (
  SELECT n_nationkey, CASE n_name WHEN 'NATION_5' THEN 'Fifth Nation'
         WHEN 'NATION_7' THEN ' Republic of Seven' || chr(9) ELSE n_name END AS province_name, n_name
  FROM nation
), gdp AS (
  SELECT province_name, CAST(year(o_orderdate) AS BIGINT) AS year,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gdp_current_price,
         CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS gdp_constant_price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN published ON c_nationkey = n_nationkey
  WHERE year(o_orderdate) >= 1996 GROUP BY 1, 2
), pop AS (
  SELECT province_name, CAST(year(l_shipdate) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS population
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN published ON s_nationkey = n_nationkey
  WHERE NOT (year(l_shipdate) = 2001 AND n_name IN ('NATION_3', 'NATION_10', 'NATION_17', 'NATION_24'))
  GROUP BY 1, 2
), years AS (
  SELECT year FROM gdp UNION SELECT year FROM pop
), dim_year AS (
  SELECT CAST(row_number() OVER (ORDER BY year) AS BIGINT) AS year_id, year,
         CAST((year // 10) * 10 AS VARCHAR) || 's' AS decade, year % 10 = 0 AS is_census_year
  FROM years
), merged AS (
  SELECT coalesce(g.province_name, p.province_name) AS province_name, coalesce(g.year, p.year) AS year,
         gdp_current_price, gdp_constant_price, population
  FROM gdp g FULL OUTER JOIN pop p
    ON g.province_name IS NOT DISTINCT FROM p.province_name AND g.year IS NOT DISTINCT FROM p.year
), alias(name_key, pos, candidate) AS (
  VALUES ('fifth nation', 1, 'nation five'), ('fifth nation', 2, 'nation_5'), ('fifth nation', 3, 'province 6'),
         ('republic of seven', 1, 'province 7'), ('republic of seven', 2, 'nation_8')
), wanted AS (
  SELECT DISTINCT province_name, lower(trim(province_name, ' ' || chr(9))) AS name_key FROM merged
), tried AS (
  SELECT province_name, 0 AS pos, name_key AS candidate FROM wanted
  UNION ALL SELECT province_name, pos, candidate FROM wanted JOIN alias USING (name_key)
), resolved AS (
  SELECT province_name, province_id FROM (
    SELECT t.province_name, d.province_id,
           row_number() OVER (PARTITION BY t.province_name ORDER BY t.pos, d.province_id) AS nth
    FROM tried t JOIN dim_province d
      ON t.candidate = d.province_name_match OR t.candidate = d.province_name_en_match
  ) WHERE nth = 1
), fact_economics AS (
  SELECT CAST(row_number() OVER (ORDER BY m.province_name, m.year) AS BIGINT) AS economics_id,
         r.province_id, y.year_id, m.gdp_current_price, m.gdp_constant_price, m.population,
         m.gdp_current_price * 1000 / NULLIF(CAST(m.population AS DOUBLE), 0) AS gdp_per_capita
  FROM merged m JOIN resolved r ON m.province_name = r.province_name JOIN dim_year y ON m.year = y.year
)
"""

_LATEST = "dy.year = (SELECT max(year) FROM dim_year)"
_JOINED = """FROM fact_economics f JOIN dim_province dp ON f.province_id = dp.province_id
JOIN dim_year dy ON f.year_id = dy.year_id"""


def _round(expression: str) -> str:
    """Round half away from zero on the decimal rendering."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _avg_exact(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(28,6))) AS DOUBLE) / count({column})"


def _selective(gold):
    return A.selective_star(gold, ("NATION_0", "NATION_5"), 2000)


def _by_sql(gold):
    """The national trend as SQL text over the registered tables."""
    A.register_gold({name: gold[name] for name in ("dim_year", "fact_economics")})
    return gold["dim_year"].sparkSession.sql("""
        SELECT year, sum(population) AS total_national_population, count(DISTINCT province_id) AS province_count,
          round(avg(gdp_per_capita), 2) AS avg_gdp_per_capita,
          round(CAST(sum(CAST(gdp_current_price AS DECIMAL(28,6))) AS DOUBLE), 2) AS total_national_gdp
        FROM fact_economics JOIN dim_year USING (year_id) WHERE population > 0 GROUP BY year ORDER BY year""")


_TREND = f"""SELECT year, CAST(sum(population) AS BIGINT) AS total_national_population,
count(DISTINCT province_id) AS province_count, {_round('avg(gdp_per_capita)')} AS avg_gdp_per_capita,
{_round('CAST(sum(CAST(gdp_current_price AS DECIMAL(28,6))) AS DOUBLE)')} AS total_national_gdp
FROM fact_economics f JOIN dim_year dy ON f.year_id = dy.year_id WHERE population > 0 GROUP BY year"""

_DENSITY = f"""SELECT province_name, population, area_km2,
{_round('CAST(population AS DOUBLE) / NULLIF(area_km2, 0)')} AS population_density,
{_round('gdp_per_capita')} AS gdp_per_capita_juta, gdp_current_price AS total_gdp_miliar {_JOINED}
WHERE {_LATEST} AND area_km2 > 0 AND population > 0 ORDER BY population_density DESC, province_name LIMIT 10"""

QUERIES = {
    "dim_entity": (_on_gold(lambda g: g["dim_province"]), STAR + "SELECT * FROM dim_province"),
    "dim_year": (_on_gold(lambda g: g["dim_year"]), STAR + "SELECT * FROM dim_year"),
    "fact_outer_merge": (_on_gold(lambda g: g["fact_economics"]), STAR + "SELECT * FROM fact_economics"),
    "unmatched_report": (
        _on_gold(lambda g: g["unmatched"]),
        STAR + "SELECT province_name FROM wanted WHERE province_name NOT IN (SELECT province_name FROM resolved)",
    ),
    "gold_summary": (
        _on_gold(gold_summary),
        STAR + """SELECT 'dim_province' AS table_name, count(*) AS records FROM dim_province
UNION ALL SELECT 'dim_year', count(*) FROM dim_year UNION ALL SELECT 'dim_indicator', 3
UNION ALL SELECT 'fact_economics', count(*) FROM fact_economics
UNION ALL SELECT 'unmatched', count(*) FROM wanted WHERE province_name NOT IN (SELECT province_name FROM resolved)""",
    ),
    "top_per_capita_latest": (
        _on_gold(A.top_per_capita),
        STAR + f"""SELECT province_name, province_name_en, gdp_current_price, population,
{_round('gdp_per_capita')} AS gdp_per_capita_juta, area_km2 {_JOINED}
WHERE {_LATEST} AND gdp_per_capita IS NOT NULL ORDER BY gdp_per_capita DESC, province_name LIMIT 5""",
    ),
    "band_averages": (
        _on_gold(lambda g: A.band_averages(g, BANDS)),
        STAR + f"""SELECT CASE
  WHEN province_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') THEN 'Low'
  WHEN province_name LIKE '%NATION_1%' THEN 'Teens'
  WHEN province_name LIKE '%NATION_2%' OR province_name = 'NATION_9' THEN 'Mixed'
  ELSE 'Lainnya' END AS island_group, count(*) AS province_count,
{_round(_avg_exact('gdp_current_price'))} AS avg_gdp_miliar, CAST(sum(population) AS BIGINT) AS total_population,
{_round('avg(gdp_per_capita)')} AS avg_gdp_per_capita {_JOINED} WHERE {_LATEST} GROUP BY 1""",
    ),
    "yoy_growth": (
        _on_gold(lambda g: A.yoy_growth(g, GROWTH_NAMES)),
        STAR + f""", prior AS (
  SELECT province_name, year, gdp_current_price,
         lag(gdp_current_price) OVER (PARTITION BY province_name ORDER BY year) AS prev_year_gdp {_JOINED}
  WHERE province_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_10'))
SELECT *, {_round('(gdp_current_price - prev_year_gdp) / NULLIF(prev_year_gdp, 0) * 100')} AS growth_rate_pct FROM prior""",
    ),
    "national_trend": (_on_gold(A.national_trend), STAR + _TREND),
    "sql_views": (_on_gold(_by_sql), STAR + _TREND),
    "above_below_average": (
        _on_gold(A.above_below_average),
        STAR + f""", latest AS (
  SELECT f.* FROM fact_economics f JOIN dim_year dy ON f.year_id = dy.year_id
  WHERE {_LATEST} AND gdp_per_capita IS NOT NULL)
SELECT CASE WHEN gdp_per_capita >= (SELECT avg(gdp_per_capita) FROM latest) THEN 'Di Atas Rata-rata'
            ELSE 'Di Bawah Rata-rata' END AS kategori, count(*) AS jumlah_provinsi,
{_round('avg(gdp_per_capita)')} AS avg_gdp_per_capita, {_round('min(gdp_per_capita)')} AS min_gdp_per_capita,
{_round('max(gdp_per_capita)')} AS max_gdp_per_capita, CAST(sum(population) AS BIGINT) AS total_populasi
FROM latest GROUP BY 1""",
    ),
    "density_topk": (_on_gold(A.density_ranking), STAR + _DENSITY),
    "pruned_latest": (pruned_latest, STAR + _DENSITY),
    "selective_star": (
        _on_gold(_selective),
        STAR + f"SELECT province_name, year, gdp_current_price {_JOINED} "
        "WHERE province_name IN ('NATION_0', 'NATION_5') AND year = 2000",
    ),
}
