"""Nested JSON responses to flat rows.

Each response is one row with nested columns. The dictionary of a cube is a relation of its own, joined
with the cells; the few columns of a table-service payload are looked up inside its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numbers import grouped_to_double, nan_to_null, scale_to_long
from strata.functions.periods import year_of_code
from strata.functions.text import conform_title
from strata.sources.literals import literal_table
from strata.workspace import materialize

_VALUE = T.StructType([T.StructField("value", T.StringType())])

# Graph-result variables and the columns they become.
BINDING_COLUMNS = {
    "qid": "wikidata_qid",
    "nameID": "province_name_id",
    "nameEN": "province_name_en",
    "isoCode": "iso_code",
    "population": "population",
    "populationDate": "population_date",
    "area": "area_km2",
    "capitalLabel": "capital_city",
    "lat": "latitude",
    "lon": "longitude",
    "inception": "inception_date",
}

BINDINGS_SCHEMA = T.StructType([
    T.StructField("results", T.StructType([
        T.StructField("bindings", T.ArrayType(
            T.StructType([T.StructField(name, _VALUE) for name in BINDING_COLUMNS])
        )),
    ])),
])

_DAMAGED = "_damaged"

_CODES = T.ArrayType(T.StructType([
    T.StructField("val", T.StringType()), T.StructField("label", T.StringType()),
]))

CUBE_SCHEMA = T.StructType([
    T.StructField("vervar", _CODES),
    T.StructField("turvar", _CODES),
    T.StructField("datacontent", T.MapType(T.StringType(), T.DoubleType())),
])

# A cell of the table service may be a JSON number or a locale-formatted text; a variant keeps
# that difference, which decides how it is parsed.
TABLE_SERVICE_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("kolom", T.MapType(
            T.StringType(), T.StructType([T.StructField("nama_variabel", T.StringType())])
        )),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("kode_wilayah", T.StringType()),
            T.StructField("label", T.StringType()),
            T.StructField("variables", T.MapType(
                T.StringType(), T.StructType([T.StructField("value_raw", T.VariantType())])
            )),
        ]))),
    ]))),
])

# Fixed values of the two statistics services.
CUBE_KEY_LENGTH = 14
CUBE_MEASURES = {"530": "pdrb_harga_berlaku", "531": "pdrb_harga_konstan"}
NATIONAL_LABEL = "INDONESIA"
POPULATION_PHRASE = "jumlah penduduk"
POPULATION_UNIT = 1000


def read_responses(
    spark: SparkSession, root: str, schema: T.StructType, one_per_file: bool = True, mode: str = "FAILFAST"
) -> DataFrame:
    """All responses below ``root``, one row each: one per file, or one per line.

    A file per response is one task each; lines let Spark split large files. Per-period folders
    (``th=119/``, ``tahun=2019/``) come back as a column, and a filter on it prunes folders.
    A response that cannot be read fails the job; ``mode="DROPMALFORMED"`` leaves it out, and
    ``rejected_responses`` says which those are.
    """
    reader = spark.read.schema(schema).options(multiLine=one_per_file, basePath=root, mode=mode)
    return reader.json(root)


def parse_texts(texts: DataFrame, schema: T.StructType, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows whose ``text`` is a response, with its fields; rows whose text cannot be read)."""
    wanted = T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())])
    options = {"columnNameOfCorruptRecord": _DAMAGED}
    parsed = texts.withColumn("_response", F.from_json(text, wanted, options))
    damaged = F.col("_response").isNull() | F.col(f"_response.{_DAMAGED}").isNotNull()
    fields = [F.col(f"_response.{f.name}") for f in schema.fields]
    good = parsed.filter(~damaged).select(*[c for c in texts.columns if c != text], *fields)
    return good, parsed.filter(damaged).select(*texts.columns)


def rejected_responses(
    spark: SparkSession, root: str, schema: T.StructType, one_per_file: bool = True
) -> DataFrame:
    """``file`` and ``text`` of the responses below ``root`` that cannot be read as ``schema``."""
    texts = spark.read.text(root, wholetext=one_per_file).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )
    return parse_texts(texts.filter(F.trim("text") != ""), schema)[1]


def missing_periods(df: DataFrame, period: str, expected: list[int]) -> DataFrame:
    """Expected periods for which no row arrived; check before replacing a full batch."""
    wanted = literal_table(df.sparkSession, [(p,) for p in expected], f"{period} bigint")
    return wanted.join(df.select(F.col(period).cast("long").alias(period)), period, "left_anti")


def flatten_bindings(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per binding of a graph result; a variable that is absent becomes null."""
    rows = responses.select(*keep, F.explode("results.bindings").alias("b"))
    return rows.select(
        *keep, *[F.col(f"b.{name}.value").alias(out) for name, out in BINDING_COLUMNS.items()]
    )


def _dictionary() -> Column:
    """What tells dictionaries of regions apart, 128 bits; responses with the same one share its labels."""
    return F.struct(F.xxhash64("vervar").alias("a"), F.xxhash64(F.lit(1), F.col("vervar")).alias("b"))


def cube_labels(responses: DataFrame) -> DataFrame:
    """``dictionary, region, label`` of the regions that the responses' dictionaries name.

    The last entry for a code wins. Equal dictionaries, as those of one service mostly are, count once, and
    mostly before the shuffle. Regions without a label and the national total are left out.
    """
    # the outer form, whose nulls go with the filter: for the inner one Spark adds a test of the array's
    # size below the parsing, which then happens twice
    entries = responses.select(_dictionary().alias("dictionary"), F.posexplode_outer("vervar").alias("place", "entry"))
    # without an aggregate the distinct rows are found by hashing, in each task first
    once = entries.select("dictionary", "place", F.col("entry.val").alias("region"), F.col("entry.label").alias("label")).distinct()
    last = once.groupBy("dictionary", "region").agg(F.max_by(F.struct("label"), "place")["label"].alias("label"))
    return last.filter((F.col("label") != "") & (F.upper("label") != NATIONAL_LABEL))


def flatten_cube(
    responses: DataFrame, period_code: str = "th", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Cells of a coded cube: ``kode_provinsi, nama_provinsi, tahun, turvar, nilai``.

    ``keep`` names columns of the response to carry along.

    The composite key is region(4) variable(3) measure(3) period(3) sub-period(1). Short keys,
    measures and regions outside the response's own dictionaries, and the national total
    are left out. Cells are spread first and then joined with the labels, so the work grows with cells and
    regions and not with their product. The responses are read twice. The labels are stored first: Spark
    then knows their size, and cells are not shuffled to labels that are few.
    """
    cells = responses.select(
        *keep, year_of_code(F.col(period_code)).alias("tahun"), _dictionary().alias("dictionary"),
        F.transform("turvar", lambda t: t["val"]).alias("measures"), F.explode_outer("datacontent").alias("key", "value"),
    )
    known = cells.select(
        *keep, "tahun", "dictionary", F.substring("key", 1, 4).alias("region"), F.substring("key", 8, 3).alias("measure"), "value",
    ).filter((F.length("key") >= CUBE_KEY_LENGTH) & F.array_contains("measures", F.substring("key", 8, 3)))
    labels = materialize(cube_labels(responses), "labels")
    return known.join(labels, ["dictionary", "region"]).select(
        *keep,
        F.col("region").alias("kode_provinsi"),
        conform_title(F.col("label")).alias("nama_provinsi"),
        "tahun",
        F.col("measure").alias("turvar"),
        nan_to_null(F.col("value")).alias("nilai"),
    )


def _figure(raw: Column) -> Column:
    """A JSON number as it is, though zero means no figure; a JSON text by the locale rules."""
    number = F.nullif(F.try_variant_get(raw, "$", "double"), F.lit(0.0))
    text = grouped_to_double(F.try_variant_get(raw, "$", "string"))
    return F.when(F.schema_of_variant(raw) == "STRING", text).otherwise(number)


def flatten_table_service(
    responses: DataFrame, period: str = "tahun", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Population rows: ``kode_provinsi, nama_provinsi, tahun, jumlah_penduduk``.

    The payload is the second element of ``data``. The measure is the first column whose name
    contains the population phrase. Region codes become two digits and ``00``.
    """
    second = F.try_element_at("data", F.lit(2))
    payload = responses.select(
        *keep, F.col(period).cast("bigint").alias("tahun"),
        second["kolom"].alias("kolom"), second["data"].alias("rows"),
    )
    hits = F.filter(
        F.map_entries("kolom"),
        lambda e: F.contains(F.lower(e["value"]["nama_variabel"]), F.lit(POPULATION_PHRASE)),
    )
    # One row for the first hit, none without a hit. Rows are reduced to the few fields that
    # count before they are exploded, so the payload is not copied onto each of them.
    picked = payload.select(*keep, "tahun", "rows", F.explode(F.slice(hits, 1, 1)).alias("measure"))
    cells = F.transform("rows", lambda r: F.struct(
        r["kode_wilayah"].alias("code"), r["label"].alias("label"),
        F.try_element_at(r["variables"], F.col("measure.key"))["value_raw"].alias("raw"),
    ))
    parsed = F.transform(cells, lambda c: F.struct(
        c["code"].alias("code"), c["label"].alias("label"), _figure(c["raw"]).alias("thousands"),
    ))
    rows = picked.select(*keep, "tahun", F.explode(parsed).alias("r"))
    return rows.filter(
        (F.col("r.code") != "") & (F.col("r.label") != "") & F.col("r.thousands").isNotNull()
        & (F.substring("r.code", 1, 2) != "00") & (F.upper("r.label") != NATIONAL_LABEL)
    ).select(
        *keep,
        F.concat(F.substring("r.code", 1, 2), F.lit("00")).alias("kode_provinsi"),
        conform_title(F.col("r.label")).alias("nama_provinsi"),
        "tahun",
        scale_to_long(F.col("r.thousands"), POPULATION_UNIT).alias("jumlah_penduduk"),
    )
