"""Column profiles: taken while writing, merged over batches, numbers read in one scan."""

import pytest

from strata.lake.profiles import ColumnProfile, merged_profile, read_numbers, write_profiled
from strata.operators.clean import locale_numbers

BATCHES = {
    "first": ("id int, a string, b string", [(1, "1.5", "2.5"), (2, None, "7")]),
    "second": ("id int, a string, b string", [(3, "1e3", "1.234,5"), (4, " 2 ", "unknown")]),
    "lacking": ("id int, a string", [(5, "4")]),
    "empty": ("id int, a string, b string", []),
    "nulls": ("id int, b string, a string", [(6, None, None)]),
}


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("profiled")
    paths = {}
    for name, (schema, rows) in BATCHES.items():
        paths[name] = str(root / name)
        write_profiled(spark.createDataFrame(rows, schema), paths[name], ["a", "b", "absent"])
    return paths


def test_profiles_say_what_the_cells_are(spark, batches):
    assert merged_profile(spark, [batches["first"]]) == {
        "a": ColumnProfile(True, True, True), "b": ColumnProfile(True, False, True)}
    assert merged_profile(spark, [batches["second"]])["b"] == ColumnProfile(False, False, True)
    assert merged_profile(spark, [batches["empty"]])["b"] == ColumnProfile(True, False, False)
    assert merged_profile(spark, [batches["nulls"]])["a"] == ColumnProfile(True, True, False)


def test_merging_has_no_order(spark, batches):
    paths = list(batches.values())
    assert merged_profile(spark, paths) == merged_profile(spark, paths[::-1])
    assert merged_profile(spark, paths)["b"].format == "grouped"


def test_numbers_equal_those_of_the_pass_over_all_cells(spark, batches):
    whole = None
    for schema, rows in BATCHES.values():
        batch = spark.createDataFrame(rows, schema)
        whole = batch if whole is None else whole.unionByName(batch, allowMissingColumns=True)
    expected = locale_numbers(whole, ["a", "b"], "auto").orderBy("id").collect()
    found = read_numbers(spark, list(batches.values())).select("id", "a", "b").orderBy("id").collect()
    assert found == expected
    assert [r["b"] for r in found] == [25.0, 7.0, 1234.5, None, None, None]


def test_one_scan_a_batch_and_no_aggregate(spark, batches):
    paths = [batches["first"], batches["second"]]
    plan = read_numbers(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(paths)
    assert "Aggregate" not in plan and "Join" not in plan


def test_a_batch_without_profile_is_refused(spark, tmp_path):
    spark.createDataFrame([(1, "2")], "id int, a string").write.parquet(str(tmp_path / "data"))
    with pytest.raises(FileNotFoundError):
        read_numbers(spark, [str(tmp_path)])


def test_no_profiled_column(spark, tmp_path):
    write_profiled(spark.createDataFrame([(1,)], "id int"), str(tmp_path / "bare"), ["a"])
    assert [tuple(r) for r in read_numbers(spark, [str(tmp_path / "bare")]).collect()] == [(1,)]
