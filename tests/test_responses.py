"""Flattening nested responses, with the odd cases of each service."""

import json

import pytest
from pyspark.sql import functions as F

from strata.sources import responses as R


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(folder, name, payload):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, indent=1))


def test_bindings(spark, tmp_path):
    put(tmp_path, "a.json", {"results": {"bindings": [
        {"qid": {"value": "Q1"}, "nameID": {"value": "Satu", "type": "literal"}, "area": {"value": "1.5"}},
        {"qid": {"value": "Q1"}},
    ]}})
    put(tmp_path, "b.json", {"results": {"bindings": []}})
    df = R.flatten_bindings(R.read_responses(spark, str(tmp_path), R.BINDINGS_SCHEMA))
    assert df.columns == list(R.BINDING_COLUMNS.values())
    assert rows_of(df.select("wikidata_qid", "province_name_id", "area_km2", "iso_code")) == [
        ("Q1", "Satu", "1.5", None), ("Q1", None, None, None),
    ]


CUBE = {
    "status": "OK",
    "vervar": [{"val": 1100, "label": "ACEH"}, {"val": 3100, "label": "D.K.I. JAKARTA"},
               {"val": 9999, "label": "INDONESIA"}, {"val": 1200, "label": "first"}, {"val": 1200, "label": "SUMATERA UTARA"}],
    "turvar": [{"val": 530, "label": "x"}, {"val": 531, "label": "y"}],
    "datacontent": {
        "11002865301190": 1.5, "11002865311190": 2.5, "31002865301190": 7, "12002865301190": 3.25,
        "99992865301190": 99.0, "77772865301190": 5.0, "11002869991190": 6.0, "1100286530119": 8.0,
        "31002865311190": None,
    },
}


def test_cube(spark, tmp_path):
    put(tmp_path, "th=119/response.json", CUBE)
    put(tmp_path, "th=120/response.json", {"status": "OK", "vervar": [], "turvar": []})
    df = R.flatten_cube(R.read_responses(spark, str(tmp_path), R.CUBE_SCHEMA))
    assert rows_of(df) == sorted([
        ("1100", "Aceh", 2019, "530", 1.5), ("1100", "Aceh", 2019, "531", 2.5),
        ("3100", "DKI Jakarta", 2019, "530", 7.0), ("3100", "DKI Jakarta", 2019, "531", None),
        ("1200", "Sumatera Utara", 2019, "530", 3.25),
    ], key=repr)
    assert [r[0] for r in R.missing_periods(df, "tahun", [2019, 2020]).collect()] == [2020]


def test_cubes_of_many_regions(spark):
    """Responses with dictionaries of their own, one of them large: labels are those of the cell's response."""
    n = 9000
    large = {
        "vervar": [{"val": 1000 + i, "label": f"R{i}"} for i in range(n)], "turvar": [{"val": 530}],
        "datacontent": {f"{1000 + i}2865301190": float(i) for i in range(n)},
    }
    other = {**CUBE, "vervar": [{"val": 1100, "label": "other"}, {"val": 1200, "label": None}]}
    texts = spark.createDataFrame([(1, 119, json.dumps(large)), (2, 120, json.dumps(CUBE)), (3, 120, json.dumps(other)), (4, 121, json.dumps(CUBE))],
                                  "id int, th int, text string").withColumn("r", F.from_json("text", R.CUBE_SCHEMA))
    df = R.flatten_cube(texts.select("id", "th", "r.*"), keep=("id",))
    found = {}
    for r in df.collect():
        found.setdefault(r["id"], []).append((r["kode_provinsi"], r["nama_provinsi"], r["tahun"], r["nilai"]))
    assert sorted(found[1]) == sorted((str(1000 + i), f"R{i}", 2019, float(i)) for i in range(n))
    assert len(found[2]) == len(found[4]) == 5
    assert sorted(found[3]) == [("1100", "Other", 2020, 1.5), ("1100", "Other", 2020, 2.5)]
    # equal dictionaries are one
    assert R.cube_labels(texts.select("r.*")).select("dictionary").distinct().count() == 3


def service(rows, name="Jumlah Penduduk (Ribu)"):
    return {"data": [{"page": 1}, {"kolom": {"a": {"nama_variabel": "Luas"}, "b": {"nama_variabel": name}}, "data": rows}]}


def cell(code, label, raw):
    return {"kode_wilayah": code, "label": label, "variables": {"a": {"value_raw": "1"}, "b": {"value_raw": raw}}}


@pytest.mark.parametrize("raw, people", [
    ("15.386,6", 15386600), (15386.6, 15386600), ("0", 0), (0, None), ("", None), ("-", None), ("–", None),
    ("...", None), ("NA", None), (None, None), (12, 12000), ("abc", None),
])
def test_table_service_figures(spark, raw, people):
    text = json.dumps(service([cell("1100000", "ACEH", raw)]))
    df = spark.createDataFrame([(2020, text)], "tahun int, text string")
    df = df.select("tahun", F.from_json("text", R.TABLE_SERVICE_SCHEMA).alias("r")).select("tahun", "r.*")
    expected = [] if people is None else [("1100", "Aceh", 2020, people)]
    assert rows_of(R.flatten_table_service(df)) == expected


def test_table_service_rows_left_out(spark, tmp_path):
    good = [cell(3100000, "DKI JAKARTA", "10"), cell("3400000", "D.I. YOGYAKARTA", "2,5")]
    bad = [cell("0000000", "X", "1"), cell("9900000", "Indonesia", "1"), cell(None, "X", "1"), cell("1100000", "", "1"),
           {"kode_wilayah": "1200000", "label": "X", "variables": {"a": {"value_raw": "1"}}}]
    put(tmp_path, "tahun=2019/r.json", service(good + bad))
    put(tmp_path, "tahun=2020/r.json", {"data": [{"page": 1}]})
    put(tmp_path, "tahun=2021/r.json", service(good, name="Luas lain"))
    df = R.flatten_table_service(R.read_responses(spark, str(tmp_path), R.TABLE_SERVICE_SCHEMA))
    assert rows_of(df) == [("3100", "DKI Jakarta", 2019, 10000), ("3400", "DI Yogyakarta", 2019, 2500)]
