"""Registered queries for files, landing, versions, digests and sizes.

They write below the shared scratch folder and read back what they wrote.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from strata.catalog.star import ALIASES, STAR, entities, gdp, population, table
from strata.lake import audit, digest, groups, ingest, versions
from strata.lake.footprint import footprint as layer_footprint
from strata.operators.clean import drop_audit
from strata.operators.reshape import append_batches
from strata.plans import medallion
from strata.sources import files, foreign, objects
from strata.workspace import materialize, scratch_path

SOURCE = {"source_name": "orders", "source_url": "file", "api_version": "v1", "operator_id": "tester"}


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"), "o_orderpriority",
    )


def _broken(text):
    """Text with every kind of line break, quotes, commas and backslashes in it."""
    return F.concat(text, F.lit('"\n'), text, F.lit('\r\n,"'), text, F.lit("\r\\n\\"))


_BROKEN = """%s || '"' || chr(10) || %s || chr(13) || chr(10) || ',"' || %s || chr(13) || '\\n\\'"""


def csv_roundtrip(spark, sf_dir):
    """Text with quotes, commas and padding, through CSV files and back."""
    path = scratch_path(spark, "csv")
    name = F.concat(F.lit(' "'), F.col("p_name"), F.lit('",\n\\n'), F.col("p_brand"))
    size = F.when(F.col("p_size") != 7, F.col("p_size").cast("string")).otherwise(F.lit("n/a"))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), name.alias("name"), size.alias("size"))
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.columns, escaped=True)


CSV_ROUNDTRIP = """
SELECT CAST(p_partkey AS VARCHAR) AS id, ' "' || p_name || '",' || chr(10) || '\\n' || p_brand AS name,
  CASE WHEN p_size <> 7 THEN CAST(p_size AS VARCHAR) END AS size FROM part"""


def parquet_roundtrip(spark, sf_dir):
    """Order lines through partitioned Parquet and back."""
    path = scratch_path(spark, "parquet")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    files.write_parquet(rows.repartition("l_returnflag", F.col("l_partkey") % 16), path, ["l_returnflag"])
    return files.read_parquet(spark, path).select("l_orderkey", "l_partkey", "l_quantity", F.col("l_returnflag").cast("string"))


PARQUET_ROUNDTRIP = "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem"


def format_counts(spark, sf_dir):
    """Row counts straight from files in two formats; the text has line breaks and quotes."""
    orders = _orders(spark, sf_dir).withColumn("o_orderpriority", _broken(F.col("o_orderpriority")))
    csv, parquet = scratch_path(spark, "counts-csv"), scratch_path(spark, "counts-parquet")
    files.write_csv(orders, csv)
    files.write_parquet(orders, parquet)
    return append_batches(
        files.count_in_place(spark, csv, "csv").withColumn("format", F.lit("csv")),
        files.count_in_place(spark, parquet, "parquet").withColumn("format", F.lit("parquet")),
    )


FORMAT_COUNTS = """
SELECT count(*) AS records, 'csv' AS format FROM orders UNION ALL SELECT count(*), 'parquet' FROM orders"""


def fallback_read(spark, sf_dir):
    """A primary source that is absent, and one without rows, each replaced by the alternate one."""
    path, hollow = scratch_path(spark, "alternate"), scratch_path(spark, "hollow")
    orders = _orders(spark, sf_dir)
    files.write_csv(orders, path)
    files.write_csv(orders.limit(0), hollow)
    return append_batches(*[
        files.read_with_fallback(spark, primary, path, orders.columns).withColumn("primary", F.lit(name))
        for name, primary in (("absent", scratch_path(spark, "absent")), ("hollow", hollow))])


ORDERS_AS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority FROM orders"""
FALLBACK_READ = f"SELECT *, 'absent' AS \"primary\" FROM ({ORDERS_AS_TEXT}) UNION ALL SELECT *, 'hollow' FROM ({ORDERS_AS_TEXT})"


def foreign_csv(spark, sf_dir):
    """Orders in four folders of CSV: plain, in other column order, with an extra column and line breaks in
    cells, and with records that have a cell too many; what was read and what was rejected."""
    orders = _orders(spark, sf_dir)
    text = F.col("o_orderpriority")
    shares = [
        orders,
        orders.select(*reversed(orders.columns)),
        orders.select("o_orderdate", F.lit("x,y").alias("extra"), F.concat(text, F.lit('"\n'), text, F.lit(',"')).alias("o_orderpriority"),
                      "o_totalprice", "o_orderkey", "o_custkey"),
    ]
    paths = [scratch_path(spark, "foreign") for _ in range(4)]
    for at, share in enumerate(shares):
        share.where(F.col("o_orderkey") % 4 == at).write.options(**foreign.CSV).csv(paths[at])
    # a writer that does not quote: plain lines, after a header in each part
    line = F.concat_ws(",", *orders.columns, F.when(F.col("o_orderkey") % 8 == 3, F.lit("?")))
    last = orders.where(F.col("o_orderkey") % 4 == 3).select(F.expr("o_orderkey div 4 % 4").alias("part"), F.lit(1).alias("place"), line.alias("value"))
    headers = spark.range(4).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit(",".join(orders.columns)).alias("value"))
    last.unionByName(headers).repartition(4, "part").sortWithinPartitions("place").select("value").write.text(paths[3])
    scan = foreign.scan_csv(spark, paths, ["o_orderkey", "o_totalprice", "o_orderpriority"], multiline=True)
    return files.as_cells(scan.rows).unionByName(scan.rejected.drop("path"), allowMissingColumns=True)


FOREIGN_CSV = """
WITH cells AS (
  SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, price AS o_totalprice,
  CASE WHEN o_orderkey % 4 = 2 THEN o_orderpriority || '"' || chr(10) || o_orderpriority || ',"' ELSE o_orderpriority END AS o_orderpriority,
  NULL AS record, NULL AS reason
FROM cells WHERE o_orderkey % 8 <> 3
UNION ALL SELECT NULL, NULL, NULL, concat_ws(',', o_orderkey, o_custkey, price, day, o_orderpriority, '?'), 'cells'
FROM cells WHERE o_orderkey % 8 = 3"""


def object_sizes(spark, sf_dir):
    """How many files order priorities make as lines of text, and how many bytes."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("value")).repartition(3).write.text(path)
    return objects.size(spark, path)


OBJECT_SIZES = """
SELECT CAST(3 AS BIGINT) AS files, CAST(sum(octet_length(encode(o_orderpriority)) + 1) AS BIGINT) AS bytes FROM orders"""


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def file_inventory(spark, sf_dir):
    """Table files by name: whether each is listed, whether it has bytes, and the rows counted in it."""
    listed = objects.inventory(spark, sf_dir).select(
        F.regexp_extract("path", "([^/]+)[.]parquet(?:/[^/]+)?$", 1).alias("table_name"), "length")
    sizes = listed.groupBy("table_name").agg((F.sum("length") > 0).alias("has_bytes"))
    counts = append_batches(*[
        files.count_in_place(spark, f"{sf_dir}/{name}.parquet", "parquet").withColumn("table_name", F.lit(name)) for name in TABLES])
    joined = counts.join(sizes, "table_name", "left")
    return joined.select("table_name", F.col("has_bytes").isNotNull().alias("listed"), "has_bytes", "records")


FILE_INVENTORY = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, true AS listed, true AS has_bytes, count(*) AS records FROM {name}" for name in TABLES)


def landed_text(spark, sf_dir):
    """Customer names with line breaks, landed as Parquet and as CSV and read back; the manifests' counts beside them."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), _broken(F.col("c_name")).alias("name"))
    landed = []
    for fmt in ("parquet", "csv"):
        root = scratch_path(spark, "text")
        found = ingest.ingest_if_changed(names, root, SOURCE, fmt=fmt, clock=_clock(1))
        rows = drop_audit(ingest.read_latest(spark, root))
        landed.append(rows.select("id", "name", F.lit(fmt).alias("format"), F.lit(found.records).cast("bigint").alias("records")))
    return append_batches(*landed)


LANDED_TEXT = f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, {_BROKEN.replace('%s', 'c_name')} AS name, format, (SELECT count(*) FROM customer) AS records
FROM customer CROSS JOIN (VALUES ('parquet'), ('csv')) f(format)"""


def empty_load(spark, sf_dir):
    """What an empty batch does under each policy, beside a batch of the same table with rows."""
    orders = _orders(spark, sf_dir)
    empty = orders.filter(F.col("o_orderkey") < 0)
    root = scratch_path(spark, "empty")
    found = [("full", ingest.ingest_if_changed(orders, root, SOURCE, clock=_clock(1)))]
    found.append(("skip", ingest.ingest_if_changed(empty, root, SOURCE, on_empty="skip", clock=_clock(2))))
    rows = [(policy, load.status, load.records) for policy, load in found]
    try:
        ingest.ingest_if_changed(empty, root, SOURCE, on_empty="raise", clock=_clock(3))
    except ingest.EmptyBatch:
        rows.append(("raise", "refused", 0))
    kept = ingest.read_latest(spark, root).agg(F.count("*").alias("kept"))
    return files.literal_table(spark, rows, "policy string, status string, records bigint").crossJoin(F.broadcast(kept))


EMPTY_LOAD = """
SELECT policy, status, CASE policy WHEN 'full' THEN n ELSE 0 END AS records, n AS kept
FROM (VALUES ('full', 'loaded'), ('skip', 'empty'), ('raise', 'refused')) v(policy, status) CROSS JOIN (SELECT count(*) AS n FROM orders)"""


def table_digest(spark, sf_dir):
    """Count and digest of all orders, independent of row order."""
    return digest.table_digest(_orders(spark, sf_dir).repartition(7, "o_custkey"))


TABLE_DIGEST = """
WITH rows AS (
  SELECT md5('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_totalprice":' || CAST(o_totalprice AS DECIMAL(18,2))
    || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderpriority":"' || o_orderpriority || '"}') AS h FROM orders),
sums AS (
  SELECT count(*) AS records, sum(CAST('0x' || h[1:15] AS BIGINT)) AS total FROM rows)
SELECT records, md5('o_orderkey:bigint,o_custkey:bigint,o_totalprice:decimal(18,2),o_orderdate:string,o_orderpriority:string|'
  || records || '|' || total) AS digest FROM sums"""


def row_digests(spark, sf_dir):
    """MD5 of every order's JSON text."""
    orders = _orders(spark, sf_dir)
    return orders.select("o_orderkey", digest.row_md5(orders).alias("digest"))


ROW_DIGESTS = """
SELECT o_orderkey, md5('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_totalprice":' || CAST(o_totalprice AS DECIMAL(18,2))
    || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderpriority":"' || o_orderpriority || '"}') AS digest FROM orders"""


def json_records(spark, sf_dir):
    """Event properties parsed from JSON, read by key with a default, and written again."""
    props = F.from_json("props", "map<string,bigint>")
    return table(spark, sf_dir, "events").select(
        "event_id", F.try_element_at(props, F.lit("k")).alias("k"),
        F.coalesce(F.try_element_at(props, F.lit("absent")), F.lit(-1)).cast("bigint").alias("absent"),
        F.to_json(F.struct("event_id", "event_type")).alias("record"),
    )


JSON_RECORDS = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(-1 AS BIGINT) AS absent,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS record FROM events"""


def _clock(hour):
    return datetime(2024, 1, 1, hour, tzinfo=timezone.utc)


def _loads(spark, sf_dir):
    """Three loads of which the second, in other row order, brings nothing new."""
    root = scratch_path(spark, "landing")
    orders = _orders(spark, sf_dir)
    early = orders.filter(F.col("o_orderdate") < "1999-01-01")
    results = [
        ingest.ingest_if_changed(early, root, SOURCE, fmt="csv", clock=_clock(1)),
        ingest.ingest_if_changed(early.orderBy("o_custkey"), root, SOURCE, fmt="csv", clock=_clock(2)),
        ingest.ingest_if_changed(orders, root, SOURCE, fmt="csv", clock=_clock(3)),
    ]
    return root, results


def idempotent_load(spark, sf_dir):
    """The manifests that three loads leave."""
    root, _ = _loads(spark, sf_dir)
    return ingest.load_history(spark, root).select("batch", "ingestion_timestamp", *SOURCE, "record_count", "data_format")


IDEMPOTENT_LOAD = """
SELECT '20240101_010000_000000' AS batch, '2024-01-01T01:00:00+00:00' AS ingestion_timestamp, 'orders' AS source_name,
  'file' AS source_url, 'v1' AS api_version, 'tester' AS operator_id, count(*) AS record_count, 'csv' AS data_format
FROM orders WHERE o_orderdate < '1999-01-01'
UNION ALL SELECT '20240101_030000_000000', '2024-01-01T03:00:00+00:00', 'orders', 'file', 'v1', 'tester', count(*), 'csv' FROM orders"""


def latest_landed(spark, sf_dir):
    """Rows of the newest batch, with audit columns."""
    root, _ = _loads(spark, sf_dir)
    return ingest.read_latest(spark, root)


LATEST_LANDED = ORDERS_AS_TEXT.replace(
    "o_orderpriority FROM",
    "o_orderpriority, '2024-01-01T03:00:00+00:00' AS ingestion_timestamp, 'orders' AS source_name, 'tester' AS operator_id FROM",
)


def manifest_extra(spark, sf_dir):
    """A manifest with an extra field, read back as a table."""
    path = scratch_path(spark, "manifest")
    records = table(spark, sf_dir, "orders").count()
    meta = audit.run_metadata(**SOURCE, record_count=records, data_format="csv", extra={"note": "n", "api_version": "v2"}, clock=_clock(5))
    audit.save_manifest(spark, f"{path}/manifest_1.json", meta)
    return audit.read_manifests(spark, path, "note string")


MANIFEST_EXTRA = """
SELECT '2024-01-01T05:00:00+00:00' AS ingestion_timestamp, 'orders' AS source_name, 'file' AS source_url, 'v2' AS api_version,
  'tester' AS operator_id, count(*) AS record_count, 'csv' AS data_format, 'n' AS note FROM orders"""


def _versions(spark, sf_dir):
    """Three versions of the orders; the second has a year only, the third another type."""
    path = scratch_path(spark, "versioned")
    orders = _orders(spark, sf_dir)
    versions.write_version(orders, path)
    versions.write_version(orders.filter(F.col("o_orderdate") >= "1999-01-01"), path, parameters={"mode": "Trim"})
    versions.write_version(orders.drop("o_orderpriority").withColumns({
        "o_custkey": F.col("o_custkey").cast("string"), "o_year": F.substring("o_orderdate", 1, 4),
    }), path, operation="MERGE")
    return path


def version_history(spark, sf_dir):
    """The version log without times and file names."""
    log = versions.history(spark, _versions(spark, sf_dir))
    return log.select(
        "version", "operation", F.try_element_at("operation_parameters", F.lit("mode")).alias("mode"),
        F.size("added_files").cast("bigint").alias("added"), F.size("removed_files").cast("bigint").alias("removed"),
        "num_records", F.try_element_at("schema", F.lit("o_custkey")).alias("custkey_type"),
    )


VERSION_HISTORY = """
SELECT 0 AS version, 'WRITE' AS operation, 'Overwrite' AS mode, 1 AS added, 0 AS removed, count(*) AS num_records, 'bigint' AS custkey_type FROM orders
UNION ALL SELECT 1, 'WRITE', 'Trim', 1, 0, count(*), 'bigint' FROM orders WHERE o_orderdate >= '1999-01-01'
UNION ALL SELECT 2, 'MERGE', 'Overwrite', 1, 0, count(*), 'string' FROM orders"""
VERSION_HISTORY = f"SELECT * REPLACE (CAST(version AS BIGINT) AS version, CAST(added AS BIGINT) AS added, CAST(removed AS BIGINT) AS removed) FROM ({VERSION_HISTORY})"


def as_of_read(spark, sf_dir):
    """The table as of its second version, after a third was written."""
    return versions.read_version(spark, _versions(spark, sf_dir), 1)


AS_OF_READ = """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority FROM orders WHERE o_orderdate >= '1999-01-01'"""


CUSTOMER_GROUP = "o_custkey % 64"


def _grouped(spark, sf_dir):
    """Four versions of the orders by group of customers: all, one group with other prices, one group
    left out, and the same again in another row order."""
    path = scratch_path(spark, "grouped")
    orders = _orders(spark, sf_dir)
    by = groups.by_value(CUSTOMER_GROUP, F.expr(CUSTOMER_GROUP))
    raised = F.when(F.expr(f"{CUSTOMER_GROUP} = 5"), (F.col("o_totalprice") + 1).cast("decimal(18,2)")).otherwise(F.col("o_totalprice"))
    second = orders.withColumn("o_totalprice", raised)
    third = second.where(f"{CUSTOMER_GROUP} <> 7")
    for rows in (orders, second, third, third.repartition(7, "o_orderdate")):
        versions.write_groups(rows, path, by)
    return path


def version_groups(spark, sf_dir):
    """How many groups each version has, stored and replaced, from the log."""
    return versions.history(spark, _grouped(spark, sf_dir)).select(
        "version", F.size("groups").cast("bigint").alias("groups"), F.size("added_files").cast("bigint").alias("stored"),
        F.size("removed_files").cast("bigint").alias("replaced"), "num_records")


VERSION_GROUPS = f"""
WITH g AS (SELECT {CUSTOMER_GROUP} AS g, count(*) AS n FROM orders GROUP BY 1),
v(version) AS (VALUES (0), (1), (2), (3))
SELECT CAST(version AS BIGINT) AS version, count(*) FILTER (version < 2 OR g <> 7) AS groups,
  count(*) FILTER (version = 0 OR version = 1 AND g = 5) AS stored,
  count(*) FILTER (version = 1 AND g = 5 OR version = 2 AND g = 7) AS replaced,
  CAST(sum(n) FILTER (version < 2 OR g <> 7) AS BIGINT) AS num_records
FROM g CROSS JOIN v GROUP BY version"""


def as_of_groups(spark, sf_dir):
    """The first and the last of the versions that share files, as they read afterwards."""
    path = _grouped(spark, sf_dir)
    return append_batches(*[versions.read_version(spark, path, v).withColumn("version", F.lit(v)) for v in (0, 3)])


AS_OF_GROUPS = f"""
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  o_orderpriority, 0 AS version FROM orders
UNION ALL SELECT o_orderkey, o_custkey,
  CAST(CASE WHEN {CUSTOMER_GROUP} = 5 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)),
  strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority, 3 FROM orders WHERE {CUSTOMER_GROUP} <> 7"""


def changed_groups(spark, sf_dir):
    """Groups of the first and the last version side by side, by their digests in the log."""
    return versions.group_changes(spark, _grouped(spark, sf_dir), 0, 3)


CHANGED_GROUPS = f"""
SELECT CAST({CUSTOMER_GROUP} AS VARCHAR) AS name, count(*) AS old_records, CASE WHEN {CUSTOMER_GROUP} <> 7 THEN count(*) END AS new_records,
  CASE {CUSTOMER_GROUP} WHEN 5 THEN 'changed' WHEN 7 THEN 'removed' ELSE 'same' END AS change
FROM orders GROUP BY {CUSTOMER_GROUP}"""


def group_digests(spark, sf_dir):
    """Count and summed row digests of every group of customers: the level of the digest below the table's."""
    return groups.group_digests(_orders(spark, sf_dir), F.expr(CUSTOMER_GROUP).cast("string"))


GROUP_DIGESTS = f"""
WITH rows AS (
  SELECT o_custkey, md5('{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_totalprice":' || CAST(o_totalprice AS DECIMAL(18,2))
    || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d') || '","o_orderpriority":"' || o_orderpriority || '"}}') AS h FROM orders)
SELECT CAST({CUSTOMER_GROUP} AS VARCHAR) AS name, count(*) AS records, CAST(sum(CAST('0x' || h[1:15] AS BIGINT)) AS VARCHAR) AS digest
FROM rows GROUP BY {CUSTOMER_GROUP}"""


def period_landing(spark, sf_dir):
    """Orders landed by year, then one year again with other prices beside one unchanged: what each load brought."""
    root = scratch_path(spark, "periods")
    year = F.substring("o_orderdate", 1, 4)
    orders = _orders(spark, sf_dir)
    by = groups.by_value("year of o_orderdate", year)
    ingest.ingest_changed_groups(orders, root, SOURCE, by, clock=_clock(1))
    later = orders.where(year.isin("1995", "1996")).withColumn(
        "o_totalprice", F.when(year == "1995", (F.col("o_totalprice") + 1).cast("decimal(18,2)")).otherwise(F.col("o_totalprice")))
    ingest.ingest_changed_groups(later, root, SOURCE, by, clock=_clock(2))
    return ingest.read_latest(spark, root).groupBy(year.alias("year"), "ingestion_timestamp").agg(
        F.count("*").alias("records"), F.sum("o_totalprice").cast("decimal(28,2)").alias("total"))


PERIOD_LANDING = """
SELECT strftime(o_orderdate, '%Y') AS year,
  CASE strftime(o_orderdate, '%Y') WHEN '1995' THEN '2024-01-01T02:00:00+00:00' ELSE '2024-01-01T01:00:00+00:00' END AS ingestion_timestamp,
  count(*) AS records, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) + CASE strftime(o_orderdate, '%Y') WHEN '1995' THEN 1 ELSE 0 END) AS DECIMAL(28,2)) AS total
FROM orders GROUP BY 1, 2"""


def schema_changes(spark, sf_dir):
    """Columns of the first and the last version side by side."""
    return versions.schema_changes(spark, _versions(spark, sf_dir), 0, 2)


SCHEMA_CHANGES = """
SELECT * FROM (VALUES ('o_custkey', 'bigint', 'string', 'changed'), ('o_orderdate', 'string', 'string', 'same'),
  ('o_orderkey', 'bigint', 'bigint', 'same'), ('o_orderpriority', 'string', NULL, 'removed'),
  ('o_totalprice', 'decimal(18,2)', 'decimal(18,2)', 'same'), ('o_year', NULL, 'string', 'added')) v("column", old_type, new_type, change)"""


def footprint(spark, sf_dir):
    """The orders as CSV and as Parquet, which layers have bytes and whether they shrink, and a dataset with one layer."""
    orders = _orders(spark, sf_dir)
    csv, parquet = scratch_path(spark, "fp-csv"), scratch_path(spark, "fp-parquet")
    files.write_csv(orders, csv)
    files.write_parquet(orders, parquet)
    sizes = layer_footprint(spark, {
        "orders": {"bronze": csv, "silver": parquet, "gold": None},
        "part": {"bronze": scratch_path(spark, "absent"), "silver": f"{sf_dir}/part.parquet", "gold": None},
    })
    return sizes.select(
        "dataset", *[F.col(f"{layer}_bytes").isNotNull().alias(f"has_{layer}") for layer in ("bronze", "silver", "gold")],
        (F.col("bronze_bytes") > F.col("silver_bytes")).alias("shrinks"), F.col("compression_ratio").isNotNull().alias("has_ratio"),
        F.when(F.col("dataset") == "orders", F.lit(files.read_csv(spark, csv).count())).alias("records"))


FOOTPRINT = """
SELECT 'orders' AS dataset, true AS has_bronze, true AS has_silver, false AS has_gold, true AS shrinks, true AS has_ratio, count(*) AS records FROM orders
UNION ALL SELECT 'part', false, true, false, NULL, false, NULL"""


def medallion_flow(spark, sf_dir):
    """Landing, Silver and Gold end to end on disk; the stored facts with their names."""
    root = scratch_path(spark, "lake")
    landed = {
        "wikidata_provinces": entities(spark, sf_dir),
        "bps_pdrb": gdp(spark, sf_dir).withColumnsRenamed({
            "province_code": "kode_provinsi", "province_name": "nama_provinsi", "year": "tahun",
            "gdp_current_price": "pdrb_harga_berlaku", "gdp_constant_price": "pdrb_harga_konstan",
        }),
        "bps_populasi": population(spark, sf_dir).withColumnsRenamed({
            "province_code": "kode_provinsi", "province_name": "nama_provinsi", "year": "tahun",
            "population": "jumlah_penduduk",
        }),
    }
    for name, df in landed.items():
        # A load reads its input twice, to compare and to write, so an expensive one is stored first.
        ingest.ingest_if_changed(materialize(df, name), f"{root}/{medallion.BRONZE[name]}", SOURCE, clock=_clock(7))
    medallion.refresh_silver(spark, root)
    medallion.refresh_gold(spark, root, ALIASES)
    gold = medallion.read_gold(spark, root)
    facts = gold["fact_economics"].join(gold["dim_province"], "province_id").join(gold["dim_year"], "year_id")
    return facts.select("province_name", "year", "gdp_current_price", "gdp_constant_price", "population", "gdp_per_capita")


MEDALLION_FLOW = STAR + """SELECT province_name, year, gdp_current_price, gdp_constant_price, population, gdp_per_capita
FROM fact_economics JOIN dim_province USING (province_id) JOIN dim_year USING (year_id)"""


QUERIES = {
    "csv_roundtrip": (csv_roundtrip, CSV_ROUNDTRIP),
    "parquet_roundtrip": (parquet_roundtrip, PARQUET_ROUNDTRIP),
    "format_counts": (format_counts, FORMAT_COUNTS),
    "fallback_read": (fallback_read, FALLBACK_READ),
    "foreign_csv": (foreign_csv, FOREIGN_CSV),
    "object_sizes": (object_sizes, OBJECT_SIZES),
    "file_inventory": (file_inventory, FILE_INVENTORY),
    "landed_text": (landed_text, LANDED_TEXT),
    "empty_load": (empty_load, EMPTY_LOAD),
    "table_digest": (table_digest, TABLE_DIGEST),
    "row_digests": (row_digests, ROW_DIGESTS),
    "json_records": (json_records, JSON_RECORDS),
    "idempotent_load": (idempotent_load, IDEMPOTENT_LOAD),
    "latest_landed": (latest_landed, LATEST_LANDED),
    "manifest_extra": (manifest_extra, MANIFEST_EXTRA),
    "version_history": (version_history, VERSION_HISTORY),
    "as_of_read": (as_of_read, AS_OF_READ),
    "version_groups": (version_groups, VERSION_GROUPS),
    "as_of_groups": (as_of_groups, AS_OF_GROUPS),
    "changed_groups": (changed_groups, CHANGED_GROUPS),
    "group_digests": (group_digests, GROUP_DIGESTS),
    "period_landing": (period_landing, PERIOD_LANDING),
    "schema_changes": (schema_changes, SCHEMA_CHANGES),
    "footprint": (footprint, FOOTPRINT),
    "medallion_flow": (medallion_flow, MEDALLION_FLOW),
}
