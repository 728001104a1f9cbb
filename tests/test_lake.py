"""Landing, digests, versions and sizes, including what a crash or a second writer leaves."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from strata.lake import audit, digest, ingest, versions
from strata.lake.footprint import footprint
from strata.sources import files, objects
from strata.workspace import materialize, scratch_path

SOURCE = {"source_name": "s", "source_url": "u", "api_version": "v1", "operator_id": "o"}


def clock(minute):
    return datetime(2024, 5, 1, 12, minute, tzinfo=timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, name string")


def sealed(df):
    return tuple(digest.table_digest(df).first())


def test_digest_ignores_order_but_not_duplicates(spark):
    rows = [(i % 7, f"n{i % 5}") for i in range(100)]
    base = sealed(frame(spark, rows))
    assert sealed(frame(spark, rows[::-1]).repartition(9)) == base
    assert sealed(frame(spark, rows + rows[:1])) != base
    assert sealed(frame(spark, rows + rows[:1] * 2)) != base
    assert sealed(frame(spark, [(1, None)])) != sealed(frame(spark, [(1, "")]))
    assert sealed(frame(spark, [(1, "x")])) != sealed(spark.createDataFrame([(1, "x")], "k long, name string"))
    assert sealed(frame(spark, []))[0] == 0


def test_second_load_is_a_no_op(spark, tmp_path):
    root, rows = str(tmp_path / "d"), [(1, "a"), (2, None)]
    assert ingest.latest_batch(spark, root) is None and ingest.stored_digest(spark, root) is None
    first = ingest.ingest_if_changed(frame(spark, rows), root, SOURCE, clock=clock(1))
    again = ingest.ingest_if_changed(frame(spark, rows[::-1]), root, SOURCE, clock=clock(2))
    changed = ingest.ingest_if_changed(frame(spark, rows + [(3, "c")]), root, SOURCE, fmt="parquet", clock=clock(3))
    assert [r.status for r in (first, again, changed)] == [ingest.LOADED, ingest.UNCHANGED, ingest.LOADED]
    assert first.digest == again.digest == sealed(frame(spark, rows))[1]
    assert ingest.stored_digest(spark, root) == changed.digest
    history = ingest.load_history(spark, root).orderBy("batch").collect()
    assert [(r.record_count, r.data_format) for r in history] == [(2, "parquet"), (3, "parquet")]
    latest = ingest.read_latest(spark, root)
    assert latest.count() == 3 and set(audit.AUDIT_COLUMNS) <= set(latest.columns)


def test_a_batch_without_manifest_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "d")
    ingest.ingest_if_changed(frame(spark, [(1, "a")]), root, SOURCE, clock=clock(1))
    files.write_parquet(frame(spark, [(9, "half")]), ingest.batch_path(root, "20991231_000000_000000"))
    assert [r.name for r in ingest.read_latest(spark, root).collect()] == ["a"]


def test_empty_batches(spark, tmp_path):
    empty = frame(spark, [])
    with pytest.raises(ingest.EmptyBatch):
        ingest.ingest_if_changed(empty, str(tmp_path), SOURCE)
    assert ingest.ingest_if_changed(empty, str(tmp_path), SOURCE, on_empty="skip").status == ingest.EMPTY
    with pytest.raises(ValueError):
        ingest.ingest_if_changed(empty, str(tmp_path), SOURCE, on_empty="ignore")


def test_manifests(spark, tmp_path):
    path = str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        audit.read_manifests(spark, path)
    meta = audit.run_metadata(**SOURCE, record_count=4, data_format="csv", extra={"operator_id": "other", "note": "é"})
    audit.save_manifest(spark, f"{path}/manifest_1.json", meta)
    with pytest.raises(objects.ObjectExists):
        audit.save_manifest(spark, f"{path}/manifest_1.json", meta)
    row = audit.read_manifests(spark, path, "note string").first()
    assert (row.operator_id, row.record_count, row.note) == ("other", 4, "é")


def test_audit_columns_missing_from_metadata(spark):
    df = audit.with_audit(spark.range(1), {"source_name": "s"})
    assert df.columns == ["id", "source_name"]


def test_versions(spark, tmp_path):
    table = str(tmp_path / "t")
    assert versions.current_version(spark, table) == -1
    with pytest.raises(LookupError):
        objects.write_text(spark, f"{table}/log/notes.json", "{}")
        versions.read_version(spark, table)
    a = versions.write_version(frame(spark, [(1, "a")]), table)
    b = versions.write_version(spark.createDataFrame([(1, "a"), (2, "b")], "k long, other string"), table, "MERGE", {"by": "x"})
    assert (a.version, b.version, versions.current_version(spark, table)) == (0, 1, 1)
    assert [tuple(r) for r in versions.read_version(spark, table, 0).collect()] == [(1, "a")]
    assert versions.read_version(spark, table).columns == ["k", "other"]
    assert versions.read_version(spark, table).count() == b.num_records == 2
    assert b.checksum == sealed(versions.read_version(spark, table))[1]
    log = versions.history(spark, table).collect()
    assert [(r.version, r.operation, r.operation_parameters) for r in log] == [
        (0, "WRITE", {"mode": "Overwrite"}), (1, "MERGE", {"by": "x"}),
    ]
    changes = {r["column"]: r.change for r in versions.schema_changes(spark, table, 0, 1).collect()}
    assert changes == {"k": "changed", "name": "removed", "other": "added"}


def test_a_second_writer_takes_the_next_version(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    versions.write_version(frame(spark, [(1, "a")]), table)
    monkeypatch.setattr(versions, "next_version", lambda *_: 0)  # both saw an empty log
    late = versions.write_version(frame(spark, [(2, "b")]), table)
    assert late.version == 1
    assert versions.read_version(spark, table, 0).first().name == "a"
    assert versions.read_version(spark, table, 1).first().name == "b"


def test_bad_log_entries_are_skipped(spark, tmp_path):
    table = str(tmp_path / "t")
    versions.write_version(frame(spark, [(1, "a")]), table)
    objects.write_text(spark, f"{table}/log/00000005.json", '{"version": 5, "timest')
    assert [r.version for r in versions.history(spark, table).collect()] == [0]
    assert versions.current_version(spark, table) == 0
    assert versions.read_version(spark, table).first().name == "a"
    assert versions.write_version(frame(spark, [(1, "b")]), table).version == 6


def test_empty_version(spark, tmp_path):
    table = str(tmp_path / "t")
    assert versions.write_version(frame(spark, []), table).num_records == 0
    assert versions.read_version(spark, table).count() == 0


def test_csv_roundtrip_keeps_text(spark, tmp_path):
    rows = [("a,b", ' "q" '), ("", "NA"), ("é", "x\ty")]
    files.write_csv(spark.createDataFrame(rows, "c string, d string"), str(tmp_path / "c"))
    back = {tuple(r) for r in files.read_csv(spark, str(tmp_path / "c")).collect()}
    assert back == {("a,b", ' "q" '), (None, None), ("é", "x\ty")}


BROKEN = [
    (1, "two\nlines"), (2, "a\r\nb"), (3, 'q"uo,te"\r'), (4, "\\n is no break, \\ nor \\\\s"), (5, " pad "), (6, None), (7, "\n"),
]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_landing_keeps_line_breaks(spark, tmp_path, fmt):
    rows = spark.createDataFrame([(str(k), name) for k, name in BROKEN], "k string, name string")
    before = sealed(rows)
    root = str(tmp_path / fmt)
    assert ingest.ingest_if_changed(rows, root, SOURCE, fmt=fmt, clock=clock(1)).records == len(BROKEN)
    back = ingest.read_latest(spark, root).drop(*audit.AUDIT_COLUMNS)
    assert sealed(back) == before
    assert files.count_in_place(spark, ingest.batch_path(root, ingest.latest_batch(spark, root)), fmt).first()[0] == len(BROKEN)


def test_fallback_where_the_primary_is_hollow(spark, tmp_path):
    files.write_csv(frame(spark, [(1, "a")]), str(tmp_path / "alt"))
    files.write_csv(frame(spark, []), str(tmp_path / "hollow"))
    read = files.read_with_fallback(spark, str(tmp_path / "hollow"), str(tmp_path / "alt"), ["k", "name"])
    assert [tuple(r) for r in read.collect()] == [("1", "a")]


def test_inventory_and_what_it_leaves_out(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "_m.txt").write_text("yy")
    names = [r.path.rsplit("/", 1)[1] for r in objects.inventory(spark, str(tmp_path)).collect()]
    assert names == ["a.txt"]
    every = objects.every_object(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in every] == [("_m.txt", 2), ("a.txt", 1), ("empty.txt", 0)]
    assert every[0].modification_time is not None


def test_a_commit_names_one_version_of_each_table(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        versions.read_tables(spark, root)
    a = versions.write_version(frame(spark, [(1, "a")]), f"{root}/x").version
    assert versions.commit_tables(spark, root, {"x": a}) == 0
    versions.write_version(frame(spark, [(2, "b")]), f"{root}/x")  # not committed with the others
    objects.write_text(spark, f"{root}/commits/00000001.json", '{"version": 1, "tab')
    assert versions.read_tables(spark, root)["x"].first().name == "a"
    assert versions.commit_tables(spark, root, {"x": 1}) == 2
    assert versions.read_tables(spark, root)["x"].first().name == "b"


def test_fallback_checks_columns(spark, tmp_path):
    files.write_csv(frame(spark, [(1, "a")]), str(tmp_path / "alt"))
    read = files.read_with_fallback(spark, str(tmp_path / "no"), str(tmp_path / "alt"), ["k", "name"])
    assert read.count() == 1
    with pytest.raises(ValueError):
        files.read_with_fallback(spark, str(tmp_path / "no"), str(tmp_path / "alt"), ["k"])


def test_objects(spark, tmp_path):
    path = str(tmp_path / "x" / "note.txt")
    assert not objects.exists(spark, path) and objects.read_text(spark, path) is None
    objects.write_text(spark, path, "één\ntwo")
    objects.write_text(spark, path, "één\nthree")
    assert objects.read_text(spark, path) == "één\nthree"
    assert tuple(objects.size(spark, str(tmp_path / "x")).first()) == (1, len("één\nthree".encode()))
    with pytest.raises(objects.ObjectExists):
        objects.write_text(spark, path, "z", exclusive=True)


def test_footprint(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f.csv").write_bytes(b"x" * 300)
    (tmp_path / "b.bin").write_bytes(b"x" * 100)
    sizes = footprint(spark, {
        "one": {"bronze": str(tmp_path / "a"), "silver": str(tmp_path / "b.bin"), "gold": None},
        "two": {"bronze": str(tmp_path / "absent"), "silver": None, "gold": None},
    })
    assert [tuple(r) for r in sizes.collect()] == [("one", 300, 100, None, 3.0), ("two", None, None, None, None)]
    absent = footprint(spark, {"two": {"bronze": None}}).first()
    assert tuple(absent) == ("two", None, None, None, None)


def test_scratch_is_shared_and_unique(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    stored = materialize(spark.range(5).withColumn("x", F.lit("y")), "t")
    assert stored.count() == 5 and stored.dtypes == [("id", "bigint"), ("x", "string")]


def test_log_entry_text_is_one_json_object(spark, tmp_path):
    table = tmp_path / "t"
    versions.write_version(frame(spark, [(1, "a")]), str(table))
    entry = json.loads((table / "log" / "00000000.json").read_text())
    assert entry["num_records"] == 1 and entry["schema"] == {"k": "int", "name": "string"}


def test_versions_with_a_folder_for_each_value(spark, tmp_path):
    table = str(tmp_path / "parted")
    rows = [(i, f"n{i % 3}", i % 4 or None) for i in range(40)]
    df = spark.createDataFrame(rows, "`odd name` long, kind string, year long")
    first = versions.write_version(df, table, partition_by=["year"])
    assert (first.num_records, first.checksum) == sealed(df)
    back = versions.read_version(spark, table)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    versions.write_version(df.limit(0), table, partition_by=["year"])
    assert versions.read_version(spark, table).dtypes == df.dtypes and versions.read_version(spark, table).count() == 0
    versions.write_version(df.limit(1), table)
    assert versions.read_version(spark, table).count() == 1 and versions.read_version(spark, table, 0).count() == 40
