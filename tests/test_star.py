"""Silver and Gold builders and the analytic queries on a small lake of real-looking names."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.lake import ingest
from strata.lake.versions import current_version
from strata.plans import analytics as A
from strata.plans import gold as G
from strata.plans import medallion as M
from strata.sources import objects
from strata.sources import responses as R
from strata.workspace import application_scratch
from strata.plans.silver import clean_entities, clean_gdp, clean_population, rejected_population

SOURCE = {"source_name": "s", "source_url": "u", "api_version": "v1", "operator_id": "o"}

ENTITIES = [  # qid, local, english, iso, area, inception
    ("Q1", " Jakarta ", "Jakarta", "ID-JK", "600", "1961"),
    ("Q1", "Jakarta", "Jakarta", "ID-XX", "661", "1961"),
    ("Q2", "Daerah Istimewa Yogyakarta", "Special Region of Yogyakarta", "ID-YO", "3000.5", "NA"),
    ("Q3", "Jawa Barat", "West Java", "ID-JB", "0", "1950"),
    ("Q4", "Kalimantan Timur", "East Kalimantan", "ID-KI", "n.a.", "1957"),
    ("Q5", "Papua Barat", "West Papua", "ID-PB", "100000", "1999"),
    ("Q6", "Bekas Provinsi", "Former Province", "NULL", "1", "1900"),
    ("Q7", "Aceh", "Aceh", "ID-AC", "50000", "1959"),
]
GDP = [  # code, name, year, current, constant
    ("3100", "DKI Jakarta", "2019", "2800", "1800"), ("3100", "DKI Jakarta", "2020", "2700", "1790"),
    ("3100", "D.K.I. Jakarta", "2021", "2900", "1850"), ("3400", "D.I. Yogyakarta", "2020", "140.5", "100"),
    ("3400", "DI Yogyakarta", "2021", "150", "105"), ("3200", "Jawa Barat", "2020", "2000", "1450"),
    ("3200", "Jawa Barat", "2021", "0", "1500"), ("6400", "Kalimantan Timur", "2021", "700", "480"),
    ("1100", "Nanggroe Aceh Darussalam", "2021", "185", "135"), ("9999", "Atlantis", "2021", "1", "1"),
    ("9200", "Papua Barat", "2021", "90", "60"),
]
POPULATION = [  # code, name, year, people
    ("3100", "DKI Jakarta", "2019", "10500"), ("3100", "DKI Jakarta", "2020", "10600"), ("3100", "DKI Jakarta", "2021", "10700"),
    ("3400", "DI Yogyakarta", "2020", "3600"), ("3400", "DI Yogyakarta", "2021", "0"), ("3200", "Jawa Barat", "2021", "48000"),
    ("6400", "Kalimantan Timur", "2018", "3700"), ("6400", "Kalimantan Timur", "2021", "3800"),
    ("1100", "Nanggroe Aceh Darussalam", "2021", "5300.0"), ("9200", "Papua Barat", "2021", "12.5"),
]


def landed(spark):
    return {
        "wikidata_provinces": spark.createDataFrame(ENTITIES, "wikidata_qid string, province_name_id string, "
                                                    "province_name_en string, iso_code string, area_km2 string, inception_date string"),
        "bps_pdrb": spark.createDataFrame(GDP, "kode_provinsi string, nama_provinsi string, tahun string, "
                                          "pdrb_harga_berlaku string, pdrb_harga_konstan string"),
        "bps_populasi": spark.createDataFrame(POPULATION, "kode_provinsi string, nama_provinsi string, tahun string, jumlah_penduduk string"),
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for name, df in landed(spark).items():
        ingest.ingest_if_changed(df, f"{root}/{M.BRONZE[name]}", SOURCE)
    M.refresh_silver(spark, root)
    unmatched = [r[0] for r in M.refresh_gold(spark, root).collect()]
    return root, M.read_gold(spark, root), unmatched


def table(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_silver(spark):
    raw = landed(spark)
    entities = clean_entities(raw["wikidata_provinces"])
    assert entities.filter("wikidata_qid = 'Q1'").first().province_name_id == "Jakarta"
    assert {r.area_km2 for r in entities.collect()} == {600.0, 3000.5, 0.0, None, 100000.0, 1.0, 50000.0}
    gdp = clean_gdp(raw["bps_pdrb"].withColumn("satuan", F.lit("x")))
    assert gdp.dtypes == [("province_code", "bigint"), ("province_name", "string"), ("year", "bigint"),
                          ("gdp_current_price", "double"), ("gdp_constant_price", "double")]
    assert {r.province_name for r in gdp.collect()} >= {"DKI Jakarta", "DI Yogyakarta"}
    people = clean_population(raw["bps_populasi"])
    assert people.filter("province_name = 'Papua Barat'").first().population is None
    assert people.filter("province_code = 1100").first().population == 5300
    assert rejected_population(raw["bps_populasi"]).first()[0] == 1


def test_dimensions(lake):
    _, gold, unmatched = lake
    assert table(gold["dim_province"].orderBy("province_id"), "province_id", "iso_code", "province_name_match") == [
        (1, "ID-AC", "aceh"), (2, "ID-JB", "jawa barat"), (3, "ID-JK", "jakarta"), (4, "ID-KI", "kalimantan timur"),
        (5, "ID-PB", "papua barat"), (6, "ID-YO", "daerah istimewa yogyakarta"),
    ]
    assert table(gold["dim_year"].orderBy("year"), "year_id", "year", "decade", "is_census_year") == [
        (1, 2018, "2010s", False), (2, 2019, "2010s", False), (3, 2020, "2020s", True), (4, 2021, "2020s", False),
    ]
    assert gold["dim_indicator"].count() == 3
    assert unmatched == ["Atlantis"]


def test_facts(lake):
    _, gold, _ = lake
    facts = gold["fact_economics"].join(gold["dim_year"], "year_id").join(gold["dim_province"], "province_id")
    rows = {(r.iso_code, r.year): r for r in facts.collect()}
    assert len(rows) == 11 and sorted(r.economics_id for r in rows.values()) == list(range(1, 12))
    assert rows["ID-JK", 2019].gdp_per_capita == 2800 * 1000 / 10500
    assert rows["ID-YO", 2021].gdp_per_capita is None and rows["ID-YO", 2021].population == 0
    assert rows["ID-KI", 2018].gdp_current_price is None
    assert rows["ID-JB", 2020].population is None
    # Numbered by published name, then year: DI Yogyakarta stands before DKI Jakarta.
    assert rows["ID-YO", 2020].economics_id < rows["ID-JK", 2019].economics_id < rows["ID-JK", 2020].economics_id


def test_queries(lake):
    _, gold, _ = lake
    top = A.top_per_capita(gold, 2)
    assert table(top, "province_name", "gdp_per_capita_juta") == [("Jakarta", 271.03), ("Kalimantan Timur", 184.21)]
    bands = table(A.band_averages(gold), "island_group", "province_count", "avg_gdp_miliar")
    assert bands == [("Jawa", 2, 1450.0), ("Kalimantan", 1, 700.0), ("Sumatera", 1, 185.0), ("Lainnya", 1, 150.0), ("Papua", 1, 90.0)]
    growth = table(A.yoy_growth(gold), "province_name", "year", "growth_rate_pct")
    assert growth == [("Jakarta", 2019, None), ("Jakarta", 2020, -3.57), ("Jakarta", 2021, 7.41),
                      ("Jawa Barat", 2020, None), ("Jawa Barat", 2021, -100.0)]
    trend = table(A.national_trend(gold), "year", "total_national_population", "province_count", "total_national_gdp")
    assert trend == [(2018, 3700, 1, None), (2019, 10500, 1, 2800.0), (2020, 14200, 2, 2840.5), (2021, 67800, 4, 3785.0)]
    split = {r[0]: r[1:] for r in table(A.above_below_average(gold), "kategori", "jumlah_provinsi", "total_populasi")}
    assert split == {A.ABOVE: (2, 14500), A.BELOW: (2, 53300)}
    dense = table(A.density_ranking(gold), "province_name", "population_density")
    assert dense == [("Jakarta", 17.83), ("Aceh", 0.11)]
    assert table(A.selective_star(gold, ["Jakarta", "Aceh"], 2020), "province_name", "gdp_current_price") == [("Jakarta", 2700.0)]


def test_sql_over_registered_gold(spark, lake):
    _, gold, _ = lake
    A.register_gold(gold)
    rows = spark.sql("""
        SELECT p.province_name, sum(f.population) AS people FROM fact_economics f
        JOIN dim_province p USING (province_id) JOIN dim_year y USING (year_id)
        WHERE y.year = (SELECT max(year) FROM dim_year) AND f.population > 5000
        GROUP BY p.province_name ORDER BY people DESC LIMIT 2
    """)
    assert [tuple(r) for r in rows.collect()] == [("Jawa Barat", 48000), ("Jakarta", 10700)]


def test_a_last_year_without_facts_gives_no_top(lake):
    _, gold, _ = lake
    later = gold["dim_year"].selectExpr("year_id + 100 AS year_id", "year + 1 AS year", "decade", "is_census_year")
    assert A.top_per_capita({**gold, "dim_year": gold["dim_year"].unionByName(later)}).count() == 0


def test_facts_do_not_depend_on_row_order(spark, lake):
    _, gold, _ = lake
    raw = {k: df.repartition(5) for k, df in landed(spark).items()}
    again = G.build_gold(clean_entities(raw["wikidata_provinces"]), clean_gdp(raw["bps_pdrb"]), clean_population(raw["bps_populasi"]))
    for name in M.GOLD_TABLES:
        assert sorted(map(tuple, again[name].collect()), key=repr) == sorted(map(tuple, gold[name].collect()), key=repr)
    assert {r.table_name: r.records for r in G.gold_summary(again).collect()} == {
        "dim_province": 6, "dim_year": 4, "dim_indicator": 3, "fact_economics": 11, "unmatched": 1,
    }


def cube(code, cells, labels):
    return {
        "vervar": [{"val": int(v), "label": label} for v, label in labels.items()],
        "turvar": [{"val": 530, "label": "a"}, {"val": 531, "label": "b"}],
        "datacontent": {f"{region}286{measure}{code}0": value for (region, measure), value in cells.items()},
    }


def people(rows):
    return {"data": [{"page": 1}, {
        "kolom": {"p": {"nama_variabel": "Jumlah Penduduk"}},
        "data": [{"kode_wilayah": code, "label": label, "variables": {"p": {"value_raw": raw}}} for code, label, raw in rows],
    }]}


def test_from_raw_responses_to_a_query(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")

    def put(path, payload):
        (raw / path).parent.mkdir(parents=True, exist_ok=True)
        (raw / path).write_text(json.dumps(payload))

    put("wikidata_provinces/r.json", {"results": {"bindings": [
        {"qid": {"value": "Q1"}, "nameID": {"value": "Jakarta"}, "isoCode": {"value": "ID-JK"}, "area": {"value": "661.5"}},
        {"qid": {"value": "Q2"}, "nameID": {"value": "Aceh"}, "isoCode": {"value": "ID-AC"}},
    ]}})
    labels = {"3100": "DKI JAKARTA", "1100": "ACEH", "9999": "INDONESIA"}
    put("bps_pdrb/th=119/r.json", cube(119, {("3100", "530"): 2800.5, ("3100", "531"): 1800, ("9999", "530"): 9}, labels))
    put("bps_pdrb/th=120/r.json", cube(120, {("3100", "530"): 2700, ("1100", "530"): 170}, labels))
    put("bps_populasi/tahun=2019/r.json", people([("3100000", "DKI JAKARTA", "10.500,5"), ("0000000", "INDONESIA", "1")]))
    with pytest.raises(M.MissingPeriods):
        M.land(spark, str(raw), root, years=[2019, 2020])
    put("bps_populasi/tahun=2020/r.json", people([("3100000", "DKI JAKARTA", "10.562"), ("1100000", "ACEH", "-")]))

    loads = M.land(spark, str(raw), root, years=[2019, 2020])
    assert {n: r.records for n, r in loads.items()} == {"wikidata_provinces": 2, "bps_pdrb": 3, "bps_populasi": 2}
    again = M.land(spark, str(raw), root, years=[2019, 2020])
    assert {r.status for r in again.values()} == {ingest.UNCHANGED}

    M.refresh_silver(spark, root)
    assert M.refresh_gold(spark, root).count() == 0
    gold = M.read_gold(spark, root)
    top = A.top_per_capita(gold)
    assert table(top, "province_name", "gdp_current_price", "population", "gdp_per_capita_juta") == [
        ("Jakarta", 2700.0, 10562000, 0.26),
    ]
    assert gold["fact_economics"].count() == 3


def test_entities_fall_back_to_a_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text(",".join(M.BINDING_COLUMNS.values()) + "\nQ9,Bali,Bali,ID-BA,,,NA,,,,\n")
    rows = M.entity_batch(spark, str(tmp_path / "absent"), str(tmp_path / "f.csv")).collect()
    assert [(r.wikidata_qid, r.iso_code, r.area_km2) for r in rows] == [("Q9", "ID-BA", None)]


@pytest.mark.parametrize("content", ['{"results": {"bindings": []}}', '{"results": {"bind'])
def test_entities_fall_back_where_the_results_are_empty_or_damaged(spark, tmp_path, content):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "r.json").write_text(content)
    (tmp_path / "f.csv").write_text(",".join(M.BINDING_COLUMNS.values()) + "\nQ9,Bali,Bali,ID-BA,,,NA,,,,\n")
    rows = M.entity_batch(spark, str(tmp_path / "raw"), str(tmp_path / "f.csv")).collect()
    assert [r.wikidata_qid for r in rows] == ["Q9"]


def test_the_flow_over_lines_refuses_damaged_responses_and_cleans_up(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    labels = {"3100": "DKI JAKARTA"}
    files = {
        "wikidata_provinces/r.json": [{"results": {"bindings": [
            {"qid": {"value": "Q1"}, "nameID": {"value": "Jakarta"}, "isoCode": {"value": "ID-JK"}}]}}],
        "bps_pdrb/th=119/r.json": [cube(119, {("3100", m): v}, labels) for m, v in (("530", 2.5), ("531", 1.5), ("999", 9.0))],
        "bps_populasi/tahun=2019/r.json": [people([("3100000", "DKI JAKARTA", "10,5")])],
    }
    for path, payloads in files.items():
        (raw / path).parent.mkdir(parents=True)
        (raw / path).write_text("".join(json.dumps(p) + "\n" for p in payloads))
    cubes = raw / "bps_pdrb/th=119/r.json"
    good = cubes.read_text()
    cubes.write_text(good + good[:40] + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        M.land(spark, str(raw), root, years=[2019], one_per_file=False)
    bad = R.rejected_responses(spark, str(raw / "bps_pdrb"), R.CUBE_SCHEMA, one_per_file=False).collect()
    assert [r.text for r in bad] == [good[:40]]
    cubes.write_text(good)
    loads = M.run_flow(spark, str(raw), root, years=[2019], one_per_file=False)
    assert {r.records for r in loads.values()} == {1}
    facts = M.read_gold(spark, root)["fact_economics"].collect()
    assert [(r.gdp_current_price, r.gdp_constant_price, r.population) for r in facts] == [(2.5, 1.5, 10500)]
    assert not objects.exists(spark, application_scratch(spark))


def test_every_refresh_is_a_new_silver_version(spark, lake):
    root, _, _ = lake
    before = current_version(spark, f"{root}/silver/bps_pdrb")
    M.refresh_silver(spark, root)
    assert current_version(spark, f"{root}/silver/bps_pdrb") == before + 1
    with pytest.raises(FileNotFoundError):
        M.refresh_silver(spark, f"{root}/nowhere")
