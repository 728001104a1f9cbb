"""Registered queries for cleaning, casting, lookups, deduplication and keys.

The given tables hold no nulls and no bad cells, so each query first spoils a column by rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.catalog.star import ALIASES, table
from strata.functions import numbers as N
from strata.functions import periods as P
from strata.functions import text as X
from strata.lake.audit import run_metadata, with_audit
from strata.lake.profiles import read_numbers, write_profiled
from strata.operators import clean as C
from strata.operators import joins as J
from strata.operators.keys import dense_key
from strata.operators.reshape import append_batches, distinct_values, pivot_mean
from strata.plans.silver import clean_entities, clean_gdp, clean_population, rejected_population
from strata.sources.files import literal_table
from strata.workspace import scratch_path


# ---- text -----------------------------------------------------------------------------------

def clean_tokens(spark, sf_dir):
    """Placeholder words and padding in a text column."""
    df = table(spark, sf_dir, "customer")
    padded = F.concat(F.lit("\t "), F.col("c_mktsegment"), F.lit(" "))
    cell = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" NA "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("None"))
        .when(F.col("c_nationkey") == 3, F.lit("nan\t"))
        .when(F.col("c_nationkey") == 4, F.lit("   "))
        .when(F.col("c_nationkey") == 5, F.lit("null"))
        .otherwise(padded)
    )
    return C.clean_strings(df.select("c_custkey", cell.alias("segment")))


CLEAN_TOKENS = """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_nationkey IN (3, 4) THEN NULL
  WHEN c_nationkey = 5 THEN 'null' ELSE c_mktsegment END AS segment FROM customer"""


def scan_tokens(spark, sf_dir):
    """Cells that a CSV scan takes for null, compared as they stand."""
    df = table(spark, sf_dir, "customer")
    cell = (
        F.when(F.col("c_nationkey") == 1, F.lit("n/a")).when(F.col("c_nationkey") == 2, F.lit("#N/A"))
        .when(F.col("c_nationkey") == 3, F.lit(" NA")).when(F.col("c_nationkey") == 4, F.lit(""))
        .otherwise(F.col("c_mktsegment"))
    )
    return df.select("c_custkey", X.null_tokens(cell, X.SCAN_NULL_TOKENS).alias("segment"))


SCAN_TOKENS = """
SELECT c_custkey, CASE WHEN c_nationkey IN (1, 2, 4) THEN NULL WHEN c_nationkey = 3 THEN ' NA'
  ELSE c_mktsegment END AS segment FROM customer"""


def _region_label():
    key = F.col("c_nationkey")
    return (
        F.when(key == 0, F.lit(" D.K.I. Jakarta ")).when(key == 1, F.lit("D.I Yogyakarta"))
        .when(key == 2, F.lit("Bangka Belitung\t")).when(key == 3, F.lit("KEP. RIAU"))
        .when(key == 4, F.lit("nanggroe aceh darussalam")).when(key == 5, F.lit("D.I. ACEH-timur"))
        .otherwise(F.concat_ws(" ", F.col("c_mktsegment"), F.col("c_name")))
    )


_REGION_LABEL = """CASE c_nationkey WHEN 0 THEN ' D.K.I. Jakarta ' WHEN 1 THEN 'D.I Yogyakarta'
  WHEN 2 THEN 'Bangka Belitung' || chr(9) WHEN 3 THEN 'KEP. RIAU' WHEN 4 THEN 'nanggroe aceh darussalam'
  WHEN 5 THEN 'D.I. ACEH-timur' ELSE c_mktsegment || ' ' || c_name END"""


def conform_names(spark, sf_dir):
    """Silver spellings, landing spellings with title case, and match names side by side."""
    label = _region_label()
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.conform_exact(label).alias("silver_name"),
        X.conform_title(label).alias("landing_name"), X.match_key(label).alias("match_name"),
    )


CONFORM_NAMES = f"""
WITH raw AS (SELECT c_custkey, trim({_REGION_LABEL}, ' ' || chr(9)) AS name FROM customer)
SELECT c_custkey,
  CASE WHEN name IN ('D.I. Yogyakarta', 'D.I Yogyakarta', 'Daerah Istimewa Yogyakarta') THEN 'DI Yogyakarta'
       WHEN name IN ('D.K.I. Jakarta', 'D.K.I Jakarta', 'Daerah Khusus Ibukota Jakarta') THEN 'DKI Jakarta'
       WHEN name = 'Bangka Belitung' THEN 'Kepulauan Bangka Belitung' ELSE name END AS silver_name,
  CASE upper(name) WHEN 'D.K.I. JAKARTA' THEN 'DKI Jakarta' WHEN 'KEP. RIAU' THEN 'Kepulauan Riau'
       WHEN 'NANGGROE ACEH DARUSSALAM' THEN 'Aceh'
       ELSE array_to_string(list_transform(regexp_extract_all(name, '([A-Za-z]+|[^A-Za-z]+)'),
              lambda run: upper(run[1]) || lower(run[2:])), '') END AS landing_name,
  lower(name) AS match_name FROM raw"""


def text_pieces(spark, sf_dir):
    """Slices, lengths, containment and the rest after a prefix."""
    uri = F.concat(F.lit("http://data.example/entity/"), F.regexp_replace("c_name", "#", "/entity/"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.text_after(uri, "/entity/").alias("local_part"),
        X.text_after(F.col("c_name"), "/entity/").alias("no_prefix"),
        F.concat(F.substring("c_name", 1, 2), F.lit("00")).alias("code"),
        F.length("c_name").cast("bigint").alias("size"),
        F.contains(F.lower("c_mktsegment"), F.lit("hin")).alias("has_part"),
        F.md5("c_name").alias("name_md5"),
    )


TEXT_PIECES = """
SELECT c_custkey, replace(c_name, '#', '/entity/') AS local_part, '' AS no_prefix,
  substr(c_name, 1, 2) || '00' AS code, length(c_name) AS size,
  contains(lower(c_mktsegment), 'hin') AS has_part, md5(c_name) AS name_md5 FROM customer"""


# ---- numbers --------------------------------------------------------------------------------

def _grouped_text(number):
    """``1234.5`` as ``1.234,50``."""
    return F.translate(F.format_number(number, 2), ",.", ".,")


def locale_numbers(spark, sf_dir):
    """The column rule: one column of plain numbers, one of grouped ones, one mixed."""
    grouped = _grouped_text(F.col("o_totalprice"))
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("plain"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(grouped).alias("grouped"),
        F.when(F.col("o_orderstatus") == "O", F.lit("12.5")).otherwise(grouped).alias("mixed"),
    )
    return C.locale_numbers(df, ["plain", "grouped", "mixed"], "auto")


LOCALE_NUMBERS = """
SELECT o_orderkey, o_totalprice AS plain,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE) END AS grouped,
  CASE WHEN o_orderstatus = 'O' THEN 125.0 ELSE o_totalprice END AS mixed FROM orders"""


def profiled_numbers(spark, sf_dir):
    """The column rule over three batches whose profiles were stored when they were written."""
    grouped = _grouped_text(F.col("o_totalprice"))
    paths = []
    for status in ("F", "O", "P"):
        batch = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status).select(
            "o_orderkey", F.col("o_totalprice").cast("string").alias("plain"),
            (F.lit("12.5") if status == "O" else grouped).alias("mixed"),
        )
        paths.append(scratch_path(spark, f"profiled-{status}"))
        write_profiled(batch, paths[-1], ["plain", "mixed"])
    return read_numbers(spark, paths)


PROFILED_NUMBERS = """
SELECT o_orderkey, o_totalprice AS plain, CASE WHEN o_orderstatus = 'O' THEN 125.0 ELSE o_totalprice END AS mixed FROM orders"""


def locale_numbers_lenient(spark, sf_dir):
    """Published figures with dashes and words for "no figure"."""
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    text = (
        F.when((status == "F") & (priority == "1"), F.lit(" – ")).when((status == "F") & (priority == "2"), F.lit("..."))
        .when((status == "F") & (priority == "3"), F.lit("-")).when((status == "F") & (priority == "4"), F.lit("NA"))
        .when((status == "F") & (priority == "5"), F.lit("1d"))
        .otherwise(F.concat(F.lit(" "), _grouped_text(F.col("o_totalprice")), F.lit("\t")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", N.grouped_to_double(text).alias("figure"))


LOCALE_LENIENT = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS figure FROM orders"""


def coerce_cast(spark, sf_dir):
    """Text to double and to bigint where cells are no numbers."""
    text = (
        F.when(F.col("p_size") < 10, F.col("p_name")).when(F.col("p_size") < 20, F.col("p_size").cast("string"))
        .when(F.col("p_size") < 30, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0 ")))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", N.to_double(text).alias("as_double"), N.to_long(text).alias("as_long")
    )


COERCE_CAST = """
SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30 THEN CAST(p_size AS DOUBLE)
  ELSE p_size + CAST(0.5 AS DOUBLE) END AS as_double,
  CASE WHEN p_size BETWEEN 10 AND 29 THEN CAST(p_size AS BIGINT) END AS as_long FROM part"""


def scale_round_even(spark, sf_dir):
    """Thousands to units, halves to the even neighbour."""
    halves = F.col("event_id").cast("double") + F.lit(0.5)
    return table(spark, sf_dir, "events").select(
        "event_id", N.scale_to_long(F.col("value"), 1000).alias("units"),
        N.scale_to_long(halves, 1).alias("halves"),
    )


SCALE_ROUND_EVEN = """
SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,2)) * 1000) AS BIGINT) AS units,
  event_id + event_id % 2 AS halves FROM events"""


def ratios(spark, sf_dir):
    """GDP per head, density and growth with zero denominators."""
    line = F.col("l_linenumber") - 1
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        N.per_capita(F.col("l_extendedprice"), line.cast("bigint")).alias("per_head"),
        N.density(F.col("l_partkey"), line.cast("double")).alias("per_area"),
        N.growth_pct(F.col("l_quantity"), line.cast("double")).alias("growth"),
    )


RATIOS = """
SELECT l_orderkey, l_linenumber, l_partkey,
  l_extendedprice * 1000 / NULLIF(CAST(l_linenumber - 1 AS DOUBLE), 0) AS per_head,
  CAST(l_partkey AS DOUBLE) / NULLIF(CAST(l_linenumber - 1 AS DOUBLE), 0) AS per_area,
  (l_quantity - CAST(l_linenumber - 1 AS DOUBLE)) / NULLIF(CAST(l_linenumber - 1 AS DOUBLE), 0) * 100 AS growth
FROM lineitem"""


def period_labels(spark, sf_dir):
    """Decade, census flag, period code and file tag of order dates."""
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", P.decade(year).alias("decade"), P.is_census_year(year).alias("is_census_year"),
        P.year_of_code(year - 1900).alias("year"), P.file_tag(F.col("o_orderdate")).alias("tag"),
    )


PERIOD_LABELS = """
SELECT o_orderkey, CAST(year(o_orderdate) // 10 * 10 AS VARCHAR) || 's' AS decade,
  year(o_orderdate) % 10 = 0 AS is_census_year, CAST(year(o_orderdate) AS BIGINT) AS year,
  strftime(o_orderdate, '%Y%m%d_%H%M%S') AS tag FROM orders"""


# ---- lookups --------------------------------------------------------------------------------

def _codes(spark, *rows):
    return literal_table(spark, rows, "event_type string, label string")


def label_lookup(spark, sf_dir):
    """Code to label; events with an unknown code are dropped."""
    codes = _codes(spark, ("click", "Clicked"), ("view", "Viewed"), ("purchase", "Bought"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return J.label_lookup(events, codes, "event_type")


LABEL_LOOKUP = """
SELECT event_id, event_type, label FROM events
JOIN (VALUES ('click', 'Clicked'), ('view', 'Viewed'), ('purchase', 'Bought')) c(event_type, label) USING (event_type)"""


def semi_lookup(spark, sf_dir):
    """Events whose code is listed; a code listed twice does not repeat them."""
    codes = _codes(spark, ("click", "Clicked"), ("click", "Clicked again"), ("error", "Failed"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return J.member_rows(events, codes, "event_type")


SEMI_LOOKUP = "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'error')"


def year_lookup(spark, sf_dir):
    """Order years to keys of a year list that misses some of them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"))
    shipped = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    years = distinct_values("year", shipped.select(F.year("l_shipdate").cast("bigint").alias("year")))
    return J.key_lookup(orders, dense_key(years, "year_id", ["year"]), "year", "year_id")


YEAR_LOOKUP = """
WITH years AS (SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem WHERE l_shipdate < '1999-01-01'),
keyed AS (SELECT year, CAST(row_number() OVER (ORDER BY year) AS BIGINT) AS year_id FROM years)
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, year_id
FROM orders LEFT JOIN keyed ON year(o_orderdate) = year"""


def _spelled():
    """A customer's nation in one of several spellings, some of which no one knows."""
    number = F.col("c_nationkey").cast("string")
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("  NATION_"), number, F.lit("\t")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("province "), number))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("Republic of Seven"))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("Atlantis "), number))
        .otherwise(F.lit("Fifth Nation"))
    )


_SPELLED = """CASE c_mktsegment WHEN 'BUILDING' THEN '  NATION_' || c_nationkey || chr(9)
  WHEN 'MACHINERY' THEN 'province ' || c_nationkey WHEN 'HOUSEHOLD' THEN 'Republic of Seven'
  WHEN 'FURNITURE' THEN 'Atlantis ' || c_nationkey ELSE 'Fifth Nation' END"""

_NAMES_SQL = f"""
WITH dim AS (SELECT CAST(n_nationkey AS BIGINT) AS id, lower(n_name) AS local, 'province ' || (n_nationkey + 1) AS english FROM nation),
alias(key, pos, candidate) AS (VALUES ('fifth nation', 1, 'nation five'), ('fifth nation', 2, 'nation_5'),
  ('fifth nation', 3, 'province 6'), ('republic of seven', 1, 'province 7'), ('republic of seven', 2, 'nation_8')),
raw AS (SELECT c_custkey, {_SPELLED} AS spelled FROM customer),
keyed AS (SELECT DISTINCT spelled, lower(trim(spelled, ' ' || chr(9))) AS key FROM raw),
tried AS (SELECT spelled, 0 AS pos, key AS candidate FROM keyed
          UNION ALL SELECT spelled, pos, candidate FROM keyed JOIN alias USING (key)),
best AS (SELECT spelled, arg_min(id, pos * 1000000 + id) AS nation_id FROM tried
         JOIN dim ON candidate = local OR candidate = english GROUP BY spelled)"""


def _name_frames(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation_id"), F.lower("n_name").alias("local"),
        F.concat(F.lit("province "), (F.col("n_nationkey") + 1).cast("string")).alias("english"),
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", _spelled().alias("spelled"))
    return rows, J.alias_lookup(dim, "nation_id", ["local", "english"], ALIASES)


def alias_priority_join(spark, sf_dir):
    """Names to nations over two name columns and ranked aliases that conflict."""
    rows, lookup = _name_frames(spark, sf_dir)
    return J.resolve_names(rows, lookup, "spelled", "nation_id")


def unmatched_names(spark, sf_dir):
    """Sorted distinct names that resolve to no nation."""
    rows, lookup = _name_frames(spark, sf_dir)
    return J.unmatched(rows, lookup, "spelled")


def outer_merge(spark, sf_dir):
    """Customers and suppliers merged on nation and balance class; null keys meet null keys."""
    def side(name, prefix, value):
        nation = F.col(f"{prefix}_nationkey")
        band = F.floor(F.col(f"{prefix}_acctbal") / 100).cast("bigint")
        return table(spark, sf_dir, name).groupBy(
            F.when(nation != 7, nation).alias("nation"), F.when(band >= 0, band).alias("band")
        ).agg(F.count(F.lit(1)).alias(value))
    return J.outer_merge(side("customer", "c", "customers"), side("supplier", "s", "suppliers"), ["nation", "band"])


OUTER_MERGE = """
WITH c AS (SELECT CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS nation,
  CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS BIGINT) END AS band, count(*) AS customers FROM customer GROUP BY 1, 2),
s AS (SELECT CASE WHEN s_nationkey <> 7 THEN s_nationkey END AS nation,
  CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal / 100) AS BIGINT) END AS band, count(*) AS suppliers FROM supplier GROUP BY 1, 2)
SELECT coalesce(c.nation, s.nation) AS nation, coalesce(c.band, s.band) AS band, customers, suppliers
FROM c FULL OUTER JOIN s ON c.nation IS NOT DISTINCT FROM s.nation AND c.band IS NOT DISTINCT FROM s.band"""


# ---- whole frames ---------------------------------------------------------------------------

def keep_first_dedup(spark, sf_dir):
    """First event per user and type in time order; some users are unknown and count as one."""
    user = F.when(F.col("value") >= 1.0, F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", user.alias("user_id"), "event_type", "value")
    return C.keep_first(events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


KEEP_FIRST = """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
  FROM (SELECT event_id, ts, CASE WHEN value >= 1.0 THEN user_id END AS user_id, event_type, value FROM events))
WHERE nth = 1"""


def latest_statement_ties(spark, sf_dir):
    """Orders on each customer's latest order date, ties kept, undated orders left out."""
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", dated.alias("dated"))
    return C.latest_with_ties(orders, "o_custkey", "dated")


LATEST_TIES = """
WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS dated FROM orders)
SELECT * FROM o a WHERE dated IS NOT NULL
  AND dated = (SELECT max(dated) FROM o b WHERE b.o_custkey = a.o_custkey)"""


def pivot(spark, sf_dir):
    """Mean value per user and event type; errors carry no value, signups are not asked for."""
    value = F.when(F.col("event_type") != "error", F.col("value").cast("decimal(18,2)"))
    events = table(spark, sf_dir, "events").select("user_id", "event_type", value.alias("value"))
    wide = pivot_mean(events, ["user_id"], "event_type", "value",
                      {"click": "mean_click", "view": "mean_view", "error": "mean_error"})
    return wide.select("user_id", *[F.col(c).cast("double").alias(c) for c in wide.columns[1:]])


PIVOT = """
SELECT user_id, CAST(CAST(sum(v) FILTER (event_type = 'click') / count(v) FILTER (event_type = 'click') AS DECIMAL(22,6)) AS DOUBLE) AS mean_click,
  CAST(CAST(sum(v) FILTER (event_type = 'view') / count(v) FILTER (event_type = 'view') AS DECIMAL(22,6)) AS DOUBLE) AS mean_view,
  CAST(NULL AS DOUBLE) AS mean_error
FROM (SELECT user_id, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE event_type IN ('click', 'view'))
GROUP BY user_id"""


def period_union(spark, sf_dir):
    """One batch of orders per year that occurs, appended, each tagged with its period."""
    orders = table(spark, sf_dir, "orders")
    years = distinct_values("year", orders.select(F.year("o_orderdate").alias("year")))
    found = sorted(r["year"] for r in years.collect())  # a row per calendar year at most
    def batch(year):
        start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        rows = orders.filter((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end))
        return rows.select("o_orderkey", "o_totalprice", F.lit(year).cast("bigint").alias("period"))
    return append_batches(*[batch(year) for year in found])


PERIOD_UNION = """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS period FROM orders WHERE o_orderdate IS NOT NULL"""


def year_spine(spark, sf_dir):
    """Distinct years of two tables; a table without the column adds nothing."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("bigint").alias("year"))
    items = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").cast("bigint").alias("year"))
    return distinct_values("year", orders, items, table(spark, sf_dir, "region")).orderBy("year")


YEAR_SPINE = """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders UNION SELECT CAST(year(l_shipdate) AS BIGINT) FROM lineitem"""


def surrogate_key(spark, sf_dir):
    """Dense keys over all orders by date; the table is stored already, so it is not stored again."""
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    keyed = dense_key(orders, "order_id", ["o_orderdate", "o_orderkey"], stored=True)
    return keyed.select("order_id", "o_orderkey", "o_custkey")


SURROGATE_KEY = """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_id, o_orderkey, o_custkey FROM orders"""


def audit_columns(spark, sf_dir):
    """Audit columns added, dropped again, and added from incomplete metadata."""
    meta = run_metadata("orders", "file", "v1", "tester", 0, "parquet", {"ingestion_timestamp": "2024-01-01T00:00:00+00:00"})
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    again = C.drop_audit(with_audit(orders, meta))
    return with_audit(again, {k: meta[k] for k in ("source_name", "operator_id")})


AUDIT_COLUMNS = """
SELECT o_orderkey, o_totalprice, 'orders' AS source_name, 'tester' AS operator_id FROM orders"""


# ---- Silver builders ------------------------------------------------------------------------

def silver_entities(spark, sf_dir):
    """Customers landed as text with duplicates, cleaned into one row per id."""
    df = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    landed = df.select(
        F.concat(F.lit(" Q"), F.col("c_custkey").cast("string")).alias("wikidata_qid"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NULL")).otherwise(F.col("c_name")).alias("province_name_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("NA")).otherwise(F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("iso_code"),
        F.col("o_orderkey").cast("string").alias("population"),
        F.when(F.col("c_acctbal") < 0, F.lit("n.a.")).otherwise(F.col("c_acctbal").cast("string")).alias("area_km2"),
        F.lit("file").alias("source_name"),
    )
    return clean_entities(landed)


SILVER_ENTITIES = """
WITH raw AS (
  SELECT 'Q' || c_custkey AS wikidata_qid, CASE WHEN o_orderstatus <> 'P' THEN c_name END AS province_name_id,
    CASE WHEN o_orderstatus <> 'F' THEN lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS iso_code,
    o_orderkey AS population, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS area_km2
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT * EXCLUDE nth FROM (
  SELECT *, row_number() OVER (PARTITION BY wikidata_qid ORDER BY iso_code NULLS FIRST,
    province_name_id NULLS LAST, population NULLS LAST, area_km2 NULLS LAST) AS nth FROM raw) WHERE nth = 1"""


def _landed(spark, sf_dir, figures):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").cast("string").alias("kode_provinsi"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" D.I Yogyakarta")).otherwise(F.col("o_orderpriority")).alias("nama_provinsi"),
        F.year("o_orderdate").cast("string").alias("tahun"), *figures,
        F.lit("unit").alias("satuan"), F.lit("x").alias("operator_id"),
    )


_LANDED = """SELECT o_custkey AS province_code, CASE WHEN o_orderstatus = 'P' THEN 'DI Yogyakarta' ELSE o_orderpriority END AS province_name,
  CAST(year(o_orderdate) AS BIGINT) AS year"""


def silver_gdp(spark, sf_dir):
    """Landed GDP text: one figure plain, the other grouped with bad cells."""
    constant = F.when(F.col("o_orderstatus") == "F", F.lit("..")).otherwise(_grouped_text(F.col("o_totalprice")))
    return clean_gdp(_landed(spark, sf_dir, [
        F.col("o_totalprice").cast("string").alias("pdrb_harga_berlaku"), constant.alias("pdrb_harga_konstan"),
    ]))


SILVER_GDP = _LANDED + """, o_totalprice AS gdp_current_price,
  CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS gdp_constant_price FROM orders"""


def _head_counts():
    key = F.col("o_orderkey")
    return (
        F.when(F.col("o_orderstatus") == "F", F.concat(key.cast("string"), F.lit(".5")))
        .when(F.col("o_orderstatus") == "O", F.concat(key.cast("string"), F.lit(".0")))
        .otherwise(F.lit("None")).alias("jumlah_penduduk")
    )


def silver_population(spark, sf_dir):
    """Landed head counts; fractional ones become null."""
    return clean_population(_landed(spark, sf_dir, [_head_counts()]))


SILVER_POPULATION = _LANDED + ", CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS population FROM orders"


def rejected_cells(spark, sf_dir):
    """How many landed head counts Silver rejects."""
    return rejected_population(_landed(spark, sf_dir, [_head_counts()]))


REJECTED_CELLS = "SELECT count(*) AS rejected FROM orders WHERE o_orderstatus = 'F'"


QUERIES = {
    "clean_tokens": (clean_tokens, CLEAN_TOKENS),
    "scan_tokens": (scan_tokens, SCAN_TOKENS),
    "conform_names": (conform_names, CONFORM_NAMES),
    "text_pieces": (text_pieces, TEXT_PIECES),
    "locale_numbers": (locale_numbers, LOCALE_NUMBERS),
    "profiled_numbers": (profiled_numbers, PROFILED_NUMBERS),
    "locale_numbers_lenient": (locale_numbers_lenient, LOCALE_LENIENT),
    "coerce_cast": (coerce_cast, COERCE_CAST),
    "scale_round_even": (scale_round_even, SCALE_ROUND_EVEN),
    "ratios": (ratios, RATIOS),
    "period_labels": (period_labels, PERIOD_LABELS),
    "label_lookup": (label_lookup, LABEL_LOOKUP),
    "semi_lookup": (semi_lookup, SEMI_LOOKUP),
    "year_lookup": (year_lookup, YEAR_LOOKUP),
    "alias_priority_join": (alias_priority_join, _NAMES_SQL + " SELECT raw.*, nation_id FROM raw LEFT JOIN best USING (spelled)"),
    "unmatched_names": (unmatched_names, _NAMES_SQL + " SELECT spelled FROM keyed WHERE spelled NOT IN (SELECT spelled FROM best)"),
    "null_safe_merge": (outer_merge, OUTER_MERGE),
    "keep_first_dedup": (keep_first_dedup, KEEP_FIRST),
    "latest_statement_ties": (latest_statement_ties, LATEST_TIES),
    "pivot_mean": (pivot, PIVOT),
    "period_union": (period_union, PERIOD_UNION),
    "year_spine": (year_spine, YEAR_SPINE),
    "surrogate_key": (surrogate_key, SURROGATE_KEY),
    "audit_columns": (audit_columns, AUDIT_COLUMNS),
    "silver_entities": (silver_entities, SILVER_ENTITIES),
    "silver_gdp": (silver_gdp, SILVER_GDP),
    "silver_population": (silver_population, SILVER_POPULATION),
    "rejected_cells": (rejected_cells, REJECTED_CELLS),
}
