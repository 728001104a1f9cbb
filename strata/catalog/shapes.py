"""Registered queries for nested responses and graph patterns.

The nested input is derived from the given tables row by row, written as JSON text and
parsed back with the schemas of the real services.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.catalog.star import table
from strata.lake.triples import stored_optionals, write_triples
from strata.operators.graph import latest_statement, members
from strata.operators.reshape import append_batches, pivot_mean
from strata.plans.entities import entity_rows
from strata.sources.files import read_parquet, write_parquet
from strata.sources.responses import (
    BINDINGS_SCHEMA, CUBE_MEASURES, CUBE_SCHEMA, TABLE_SERVICE_SCHEMA, flatten_bindings, flatten_cube,
    flatten_table_service, parse_texts, read_responses, rejected_responses,
)
from strata.workspace import scratch_path


# Writing and parsing a response per row costs far more than moving the row: the narrow input is
# dealt out to this many tasks, a parameter to raise with the table.
PARSERS = 64


def _value(column):
    return F.struct(column.cast("string").alias("value"))


def bindings(spark, sf_dir):
    """Two bindings per customer; the second lacks most variables, one lacks all names."""
    first = F.struct(
        _value(F.concat(F.lit("Q"), F.col("c_custkey"))).alias("qid"),
        _value(F.col("c_name")).alias("nameID"),
        F.when(F.col("c_nationkey") != 3, _value(F.upper("c_mktsegment"))).alias("nameEN"),
        _value(F.col("c_acctbal")).alias("area"),
        _value(F.col("c_nationkey")).alias("isoCode"),
    )
    nothing = F.lit(None).cast("struct<value:string>")
    second = F.struct(
        _value(F.concat(F.lit("Q"), F.col("c_custkey"))).alias("qid"), nothing.alias("nameID"),
        nothing.alias("nameEN"), nothing.alias("area"), nothing.alias("isoCode"),
    )
    text = F.to_json(F.struct(F.struct(F.array(first, second).alias("bindings")).alias("results")))
    responses = table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))
    parsed = responses.select("c_custkey", F.from_json("text", BINDINGS_SCHEMA).alias("r")).select("c_custkey", "r.*")
    return flatten_bindings(parsed, keep=("c_custkey",))


BINDINGS = """
WITH b AS (SELECT c_custkey, 'Q' || c_custkey AS wikidata_qid, c_name, CASE WHEN c_nationkey <> 3 THEN upper(c_mktsegment) END AS en,
  CAST(c_nationkey AS VARCHAR) AS iso, c_acctbal FROM customer)
SELECT c_custkey, wikidata_qid, c_name AS province_name_id, en AS province_name_en, iso AS iso_code,
  CAST(NULL AS VARCHAR) AS population, CAST(NULL AS VARCHAR) AS population_date, CAST(c_acctbal AS VARCHAR) AS area_km2,
  CAST(NULL AS VARCHAR) AS capital_city, CAST(NULL AS VARCHAR) AS latitude, CAST(NULL AS VARCHAR) AS longitude,
  CAST(NULL AS VARCHAR) AS inception_date FROM b
UNION ALL SELECT c_custkey, wikidata_qid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM b"""


def _cube_texts(spark, sf_dir):
    """One cube per order: two good cells and one of every kind that is left out."""
    region = F.concat(F.substring("o_orderpriority", 1, 1), F.lit("100"))
    th = (F.year("o_orderdate") - 1900).cast("string")

    def key(code, measure):
        return F.concat(code, F.lit("286"), F.lit(measure), F.lpad(th, 3, "0"), F.lit("0"))

    def code(val, label):
        return F.struct(val.alias("val"), label.alias("label"))

    price = F.col("o_totalprice")
    cells = F.create_map(
        key(region, "530"), price, key(region, "531"), price / 4, key(region, "999"), price,
        key(F.lit("9999"), "530"), price, key(F.lit("8888"), "530"), price, F.lit("1100286530"), price,
    )
    text = F.to_json(F.struct(
        F.array(code(region, F.lit("OLD LABEL")), code(F.lit("9999"), F.lit("Indonesia")), code(region, F.col("o_orderpriority"))).alias("vervar"),
        F.array(code(F.lit("530"), F.lit("a")), code(F.lit("531"), F.lit("b"))).alias("turvar"),
        cells.alias("datacontent"),
    ))
    orders = table(spark, sf_dir, "orders").repartition(PARSERS)
    return orders.select("o_orderkey", th.alias("th"), text.alias("text"))


def explode_cube(spark, sf_dir):
    """Cells of one coded cube per order."""
    parsed = _cube_texts(spark, sf_dir).withColumn("r", F.from_json("text", CUBE_SCHEMA))
    return flatten_cube(parsed.select("o_orderkey", "th", "r.*"), keep=("o_orderkey",))


_TITLE = """array_to_string(list_transform(regexp_extract_all(o_orderpriority, '([A-Za-z]+|[^A-Za-z]+)'),
  lambda run: upper(run[1]) || lower(run[2:])), '')"""

EXPLODE_CUBE = f"""
SELECT o_orderkey, o_orderpriority[1] || '100' AS kode_provinsi, {_TITLE} AS nama_provinsi,
  CAST(year(o_orderdate) AS BIGINT) AS tahun, turvar, CASE turvar WHEN '530' THEN o_totalprice ELSE o_totalprice / 4 END AS nilai
FROM orders CROSS JOIN (VALUES ('530'), ('531')) m(turvar)"""


def cube_wide(spark, sf_dir):
    """Cubes landed in one folder per period, read back, one row per region and year."""
    root = scratch_path(spark, "responses")
    _cube_texts(spark, sf_dir).select("th", "text").write.partitionBy("th").text(root)
    cells = flatten_cube(read_responses(spark, root, CUBE_SCHEMA, one_per_file=False))
    cells = cells.withColumn("nilai", F.col("nilai").cast("decimal(18,4)"))
    index = ["kode_provinsi", "nama_provinsi", "tahun"]
    wide = pivot_mean(cells, index, "turvar", "nilai", CUBE_MEASURES)
    return wide.select(*index, *[F.round(c, 2).cast("double").alias(c) for c in CUBE_MEASURES.values()])


CUBE_WIDE = f"""
SELECT o_orderpriority[1] || '100' AS kode_provinsi, {_TITLE} AS nama_provinsi, CAST(year(o_orderdate) AS BIGINT) AS tahun,
  CAST(round(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS DECIMAL(22,8)), 2) AS DOUBLE) AS pdrb_harga_berlaku,
  CAST(round(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4)) / 4) AS DOUBLE) / count(*) AS DECIMAL(22,8)), 2) AS DOUBLE) AS pdrb_harga_konstan
FROM orders GROUP BY ALL"""


def table_service(spark, sf_dir):
    """One table-service payload per order: figures as text and as number, and rows left out."""
    label = F.concat(F.lit('","label":"'), F.col("o_orderpriority"))
    grouped = F.concat(F.lit('"'), F.translate(F.format_number("o_totalprice", 2), ",.", ".,"), F.lit('"'))

    def row(code, raw, label=label):
        middle = F.lit('","variables":{"v9":{"value_raw":"7"},"v1":{"value_raw":')
        return F.concat(F.lit('{"kode_wilayah":"' + code), label, middle, raw, F.lit("}}}"))

    rows = [
        row("1100000", grouped), row("0000000", grouped), row("3200000", F.lit('"-"')),
        row("3300000", F.lit('""')), row("3300000", F.lit("null")), row("3300000", F.lit("0")), row("", grouped),
        row("3100000", grouped, F.lit('","label":"Indonesia')),
        row("3400000", grouped, F.lit('","label":" D.I. YOGYAKARTA ')),
        row("3500000", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
    ]
    head = (
        '{"data":[{"page":1},{"kolom":{"v0":{"nama_variabel":"Luas Wilayah"},'
        '"v1":{"nama_variabel":"Jumlah Penduduk (Ribu)"},"v9":{"nama_variabel":"jumlah penduduk lain"}},"data":['
    )
    text = F.concat(F.lit(head), F.concat_ws(",", *rows), F.lit("]}]}"))
    orders = table(spark, sf_dir, "orders").repartition(PARSERS)
    parsed = orders.select(
        "o_orderkey", F.year("o_orderdate").alias("tahun"), F.from_json(text, TABLE_SERVICE_SCHEMA).alias("r")
    )
    return flatten_table_service(parsed.select("o_orderkey", "tahun", "r.*"), keep=("o_orderkey",))


TABLE_SERVICE = f"""
SELECT o_orderkey, kode AS kode_provinsi, CASE kode WHEN '3400' THEN 'DI Yogyakarta' ELSE {_TITLE} END AS nama_provinsi,
  CAST(year(o_orderdate) AS BIGINT) AS tahun, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 1000) AS BIGINT) AS jumlah_penduduk
FROM orders CROSS JOIN (VALUES ('1100'), ('3400'), ('3500')) k(kode)"""


DAMAGED_EVERY = 7


def _damaged_texts(spark, sf_dir):
    """The cubes as texts, of which every seventh is cut off in the middle."""
    cut = F.expr("left(text, length(text) div 2)")
    texts = _cube_texts(spark, sf_dir)
    return texts.withColumn("text", F.when(F.col("o_orderkey") % DAMAGED_EVERY == 0, cut).otherwise(F.col("text")))


def rejected(spark, sf_dir):
    """Landed responses that cannot be read, counted by their period, beside those that can."""
    root = scratch_path(spark, "damaged")
    _damaged_texts(spark, sf_dir).select("th", "text").write.partitionBy("th").text(root)
    bad = rejected_responses(spark, root, CUBE_SCHEMA, one_per_file=False)
    bad = bad.select(F.regexp_extract("file", "/th=([0-9]+)/", 1).cast("bigint").alias("th"), F.lit(1).alias("bad"))
    good = read_responses(spark, root, CUBE_SCHEMA, one_per_file=False, mode="DROPMALFORMED")
    good = good.filter(F.col("datacontent").isNotNull()).select(F.col("th").cast("bigint").alias("th"), F.lit(0).alias("bad"))
    return append_batches(bad, good).groupBy("th").agg(
        F.count_if(F.col("bad") == 1).alias("rejected"), F.count_if(F.col("bad") == 0).alias("parsed"))


REJECTED = f"""
SELECT CAST(year(o_orderdate) - 1900 AS BIGINT) AS th, count(*) FILTER (o_orderkey % {DAMAGED_EVERY} = 0) AS rejected,
  count(*) FILTER (o_orderkey % {DAMAGED_EVERY} <> 0) AS parsed FROM orders GROUP BY 1"""


def quarantine(spark, sf_dir):
    """Orders whose response cannot be read, as rows with the length of the damaged text."""
    _, bad = parse_texts(_damaged_texts(spark, sf_dir), CUBE_SCHEMA)
    return bad.select("o_orderkey", (F.length("text") > 0).alias("has_text"))


QUARANTINE = f"SELECT o_orderkey, true AS has_text FROM orders WHERE o_orderkey % {DAMAGED_EVERY} = 0"


# ---- graph ----------------------------------------------------------------------------------

PREFIX = "http://data.example/entity/"
ROOT = "http://data.example/entity/ROOT"


def triples(spark, sf_dir):
    """Customers as member entities, nations as capitals, orders as population statements.

    Stored by predicate, as a triples table should be: each pattern then reads its own folder.
    """
    customer, nation, orders = (table(spark, sf_dir, n) for n in ("customer", "nation", "orders"))
    subject = F.concat(F.lit(PREFIX + "C"), F.col("c_custkey").cast("string"))
    place = F.concat(F.lit(PREFIX + "N"), F.col("n_nationkey").cast("string"))
    owner = F.concat(F.lit(PREFIX + "C"), F.col("o_custkey").cast("string"))
    node = F.concat(F.lit("statement/"), F.col("o_orderkey").cast("string"))

    def rows(df, s, p, o, lang=None):
        return df.select(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(lang).cast("string").alias("lang"))

    segment = F.col("c_mktsegment")
    point = F.concat(F.lit("Point("), F.col("c_nationkey").cast("string"), F.lit(".5 -"), F.col("c_nationkey").cast("string"), F.lit(".25)"))
    dated = orders.filter(F.col("o_orderstatus") != "P")
    path = scratch_path(spark, "triples")
    write_parquet(append_batches(
        rows(customer, F.lit(ROOT), "wdt:P150", subject),
        rows(customer, subject, "rdfs:label", F.col("c_name"), "id"),
        rows(customer.filter(segment != "MACHINERY"), subject, "rdfs:label", F.upper("c_name"), "en"),
        rows(customer, subject, "rdfs:label", segment, "fr"),
        rows(customer.filter(segment != "HOUSEHOLD"), subject, "wdt:P300", F.lpad(F.col("c_custkey").cast("string"), 12, "0")),
        rows(customer, subject, "wdt:P2046", F.col("c_acctbal")),
        rows(customer.filter(segment != "FURNITURE"), subject, "wdt:P36", F.concat(F.lit(PREFIX + "N"), F.col("c_nationkey").cast("string"))),
        rows(customer.filter(segment != "BUILDING"), subject, "wdt:P625", point),
        rows(customer.filter(segment == "BUILDING"), subject, "wdt:P625", F.lit("nowhere")),
        rows(customer, subject, "wdt:P571", F.lit("1950-01-01")),
        rows(customer.filter(segment == "AUTOMOBILE"), subject, "wdt:P571", F.lit("1960-01-01")),
        rows(nation.filter(F.col("n_regionkey") == 0), place, "rdfs:label", F.col("n_name"), "id"),
        rows(nation.filter(F.col("n_regionkey") <= 1), place, "rdfs:label", F.lower("n_name"), "en"),
        rows(orders, owner, "p:P1082", node),
        rows(orders, node, "ps:P1082", F.col("o_totalprice")),
        rows(dated, node, "pq:P585", F.col("o_orderdate").cast("date")),
    ), path, ["p"])
    return read_parquet(spark, path)


def graph_wide_row(spark, sf_dir):
    """The entity pattern over the triples."""
    return entity_rows(triples(spark, sf_dir), ROOT, PREFIX)


GRAPH_WIDE_ROW = f"""
WITH dated AS (SELECT o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus <> 'P'),
latest AS (SELECT a.* FROM dated a WHERE NOT EXISTS (SELECT 1 FROM dated b WHERE b.o_custkey = a.o_custkey AND b.day > a.day)),
founded(day, segment) AS (VALUES ('1950-01-01', NULL), ('1960-01-01', 'AUTOMOBILE'))
SELECT '{PREFIX}C' || c_custkey AS province, 'C' || c_custkey AS wikidata_qid, c_name AS province_name_id,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN upper(c_name) END AS province_name_en,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS iso_code,
  CAST(o_totalprice AS VARCHAR) AS population, latest.day AS population_date, CAST(c_acctbal AS VARCHAR) AS area_km2,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN CASE n_regionkey WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) ELSE 'N' || n_nationkey END END AS capital_city,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST('-' || c_nationkey || '.25' AS DOUBLE) END AS latitude,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey + CAST(0.5 AS DOUBLE) END AS longitude, founded.day AS inception_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN founded ON segment IS NULL OR segment = c_mktsegment
LEFT JOIN latest ON o_custkey = c_custkey"""


def graph_latest_statement(spark, sf_dir):
    """Latest dated population statement per entity, ties kept."""
    rows = latest_statement(triples(spark, sf_dir), "p:P1082", "ps:P1082", "pq:P585", "population", "population_date")
    return rows.withColumnRenamed("s", "entity")


GRAPH_LATEST = f"""
WITH dated AS (SELECT o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus <> 'P')
SELECT '{PREFIX}C' || o_custkey AS entity, CAST(o_totalprice AS VARCHAR) AS population, day AS population_date
FROM dated a WHERE NOT EXISTS (SELECT 1 FROM dated b WHERE b.o_custkey = a.o_custkey AND b.day > a.day)"""


STORED_BUCKETS = 16
STORED_HOT_ROWS = 100  # the root and customers with that many statements are stored apart


def stored_patterns(spark, sf_dir):
    """Optional patterns of all members over triples stored by predicate and subject, hot subjects apart."""
    store = write_triples(triples(spark, sf_dir), scratch_path(spark, "triple-store"), STORED_BUCKETS, STORED_HOT_ROWS)
    subjects = members(store.triples(), ROOT, "wdt:P150").distinct()
    return stored_optionals(subjects, store, {
        "name_en": ("rdfs:label", "en"), "iso_code": ("wdt:P300", None), "capital": ("wdt:P36", None),
        "coords": ("wdt:P625", None), "inception": ("wdt:P571", None), "statement": ("p:P1082", None),
    })


STORED_PATTERNS = f"""
WITH founded(day, segment) AS (VALUES ('1950-01-01', NULL), ('1960-01-01', 'AUTOMOBILE'))
SELECT '{PREFIX}C' || c_custkey AS s, CASE WHEN c_mktsegment <> 'MACHINERY' THEN upper(c_name) END AS name_en,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS iso_code,
  CASE WHEN c_mktsegment <> 'FURNITURE' THEN '{PREFIX}N' || c_nationkey END AS capital,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Point(' || c_nationkey || '.5 -' || c_nationkey || '.25)' ELSE 'nowhere' END AS coords,
  founded.day AS inception, 'statement/' || o_orderkey AS statement
FROM customer JOIN founded ON segment IS NULL OR segment = c_mktsegment LEFT JOIN orders ON o_custkey = c_custkey"""


QUERIES = {
    "flatten_bindings": (bindings, BINDINGS),
    "explode_cube": (explode_cube, EXPLODE_CUBE),
    "cube_wide": (cube_wide, CUBE_WIDE),
    "flatten_table_service": (table_service, TABLE_SERVICE),
    "rejected_responses": (rejected, REJECTED),
    "quarantine": (quarantine, QUARANTINE),
    "graph_wide_row": (graph_wide_row, GRAPH_WIDE_ROW),
    "graph_latest_statement": (graph_latest_statement, GRAPH_LATEST),
    "stored_patterns": (stored_patterns, STORED_PATTERNS),
}
