"""Tables as groups of files: only what changed is stored, everything is read."""

import pytest
from pyspark.sql import functions as F

from strata.lake import audit, digest, groups, ingest, versions
from strata.operators.clean import AUDIT_COLUMNS
from strata.plans import medallion
from test_lake import SOURCE, clock

SCHEMA = "k long, year int, name string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files_below(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


FIRST = [(i, 2019 + i % 4, f"n{i}") for i in range(400)] + [(None, None, "none"), (7, None, None)]


def test_one_changed_bucket_is_written(spark, tmp_path):
    table, by = str(tmp_path / "t"), groups.by_hash(["k"], 64)
    first, stored = versions.write_groups(frame(spark, FIRST), table, by)
    assert len(stored.written) == len(stored.groups) <= 64 and first.num_records == len(FIRST)
    before = files_below(tmp_path / "t")
    changed = [(k, y, "other" if k == 11 else n) for k, y, n in FIRST]
    second, stored = versions.write_groups(frame(spark, list(reversed(changed))).repartition(5), table, by)
    assert len(stored.written) == 1
    new = files_below(tmp_path / "t") - before
    assert new and {f.rsplit("/", 1)[0] for f in new} == {stored.written[0].path}
    assert rows(versions.read_version(spark, table)) == sorted(changed, key=repr)
    assert rows(versions.read_version(spark, table, 0)) == sorted(FIRST, key=repr)
    assert second.checksum == digest.table_digest(frame(spark, changed)).first()["digest"]
    entry = versions.history(spark, table).orderBy("version").collect()[1]
    assert len(entry["added_files"]) == len(entry["removed_files"]) == 1 and len(entry["groups"]) == len(stored.groups)
    # the same rows again: a version, but not a file
    _, stored = versions.write_groups(frame(spark, changed), table, by)
    assert stored.written == () and files_below(tmp_path / "t") == before | new


def test_removed_rows_groups_and_schemas(spark, tmp_path):
    table, by = str(tmp_path / "t"), groups.by_value("year")
    versions.write_groups(frame(spark, FIRST), table, by)
    kept = [r for r in FIRST if r[1] not in (None, 2020)]
    _, stored = versions.write_groups(frame(spark, kept), table, by)
    assert stored.written == () and {g.name for g in stored.dropped} == {None, "2020"}
    assert rows(versions.read_version(spark, table)) == sorted(kept, key=repr)
    changes = {r["name"]: r["change"] for r in versions.group_changes(spark, table, 0, 1).collect()}
    assert changes == {None: "removed", "2019": "same", "2020": "removed", "2021": "same", "2022": "same"}
    versions.write_groups(frame(spark, FIRST), table, by)
    assert {r["change"] for r in versions.group_changes(spark, table, 1, 2).collect()} == {"same", "added"}
    # another type: nothing is shared, and the version before stays readable
    wider = frame(spark, FIRST).withColumn("year", F.col("year").cast("long"))
    _, stored = versions.write_groups(wider, table, by)
    assert len(stored.written) == 5 and dict(versions.read_version(spark, table).dtypes)["year"] == "bigint"
    assert dict(versions.read_version(spark, table, 2).dtypes)["year"] == "int"
    # another grouping shares nothing either, and an emptied table keeps its columns
    assert len(versions.write_groups(wider, table, groups.by_hash(["k"], 2))[1].written) == 2
    versions.write_groups(wider.limit(0), table, groups.by_hash(["k"], 2))
    empty = versions.read_version(spark, table)
    assert empty.dtypes == wider.dtypes and empty.count() == 0
    # after whole versions and before them
    versions.write_version(frame(spark, FIRST[:3]), table)
    assert versions.read_version(spark, table).count() == 3
    assert len(versions.write_groups(frame(spark, FIRST[:3]), table, by)[1].written) == 3
    assert versions.read_version(spark, table, 0).count() == len(FIRST)


def test_odd_labels_and_limits(spark, tmp_path, monkeypatch):
    table, by = str(tmp_path / "t"), groups.by_value("name")
    odd = [(1, 1, "a/b=c"), (2, 1, ""), (3, 1, None), (4, 1, "null"), (5, 1, "é %"), (6, 1, "__HIVE_DEFAULT_PARTITION__")]
    versions.write_groups(frame(spark, odd), table, by)
    assert rows(versions.read_version(spark, table)) == sorted(odd, key=repr)
    _, stored = versions.write_groups(frame(spark, [*odd[:2], (3, 2, None), *odd[3:]]), table, by)
    assert [g.name for g in stored.written] == [None]
    monkeypatch.setattr(groups, "MAX_GROUPS", 3)
    with pytest.raises(ValueError, match="coarser"):
        versions.write_groups(frame(spark, odd), table, by)
    with pytest.raises(ValueError):
        groups.by_hash(["k"], 4)


def test_columns_with_names_of_the_layout(spark, tmp_path):
    table = str(tmp_path / "t")
    odd = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "part int, group string, Part_ double").withColumn("d", F.lit(1).cast("decimal(9,2)"))
    versions.write_groups(odd, table, groups.by_value("part"))
    _, stored = versions.write_groups(odd.where("part = 1"), table, groups.by_value("part"))
    assert stored.written == () and rows(versions.read_version(spark, table)) == rows(odd.where("part = 1"))
    versions.write_groups(odd.limit(0), table, groups.by_value("part"))
    assert versions.read_version(spark, table).dtypes == odd.dtypes


def test_a_hot_group_is_spread_over_files(spark, tmp_path):
    """One value holds nearly all rows; the rebalancing before the write may cut its group."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(200_000).select(F.col("id").alias("k"), F.when(F.col("id") < 10, 1).otherwise(2).alias("year"), F.md5(F.col("id").cast("string")).alias("name"))
        _, stored = versions.write_groups(hot.repartition(8), str(tmp_path / "t"), groups.by_value("year"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    large = next(g for g in stored.groups if g.name == "2")
    assert len(files_below(tmp_path / "t" / large.path)) > 1
    assert stored.records == 200_000 == versions.read_version(spark, str(tmp_path / "t")).count()


def test_one_period_replaces_one_partition(spark, tmp_path):
    root, by = str(tmp_path), groups.by_value("year")
    years = [r for r in FIRST if r[1] is not None]
    first = ingest.ingest_changed_groups(frame(spark, years), root, SOURCE, by, clock=clock(1))
    assert (first.status, first.records, set(first.groups)) == ("loaded", 400, {"2019", "2020", "2021", "2022"})
    before = files_below(tmp_path)
    delivery = [(k, y, "new") for k, y, _ in years if y == 2021] + [r for r in years if r[1] == 2019]
    second = ingest.ingest_changed_groups(frame(spark, delivery), root, SOURCE, by, clock=clock(2))
    assert (second.status, second.groups, second.records) == ("loaded", ("2021",), 400)
    live = set(ingest.read_latest(spark, root).inputFiles())
    assert {f for f in before if any(f in path for path in live)} == {f for f in before if "part=2" not in f}
    latest = ingest.read_latest(spark, root)
    assert rows(latest.drop(*AUDIT_COLUMNS)) == sorted([r for r in years if r[1] != 2021] + delivery[:100], key=repr)
    stamps = {(r["year"], r["ingestion_timestamp"][14:16]) for r in latest.collect()}
    assert stamps == {(2019, "01"), (2020, "01"), (2021, "02"), (2022, "01")}
    again = ingest.ingest_changed_groups(frame(spark, delivery), root, SOURCE, by, clock=clock(3))
    assert again.status == "unchanged" and ingest.load_history(spark, root).count() == 2
    assert ingest.stored_digest(spark, root) == again.digest == digest.table_digest(latest.drop(*AUDIT_COLUMNS)).first()["digest"]
    assert {g.name for g in ingest.landed_groups(spark, root)} == {"2019", "2020", "2021", "2022"}
    dropped = ingest.ingest_changed_groups(frame(spark, delivery), root, SOURCE, by, absent="drop", clock=clock(4))
    assert dropped.status == "loaded" and dropped.groups == () and ingest.read_latest(spark, root).count() == 200


def test_empty_deliveries_and_crashes(spark, tmp_path):
    root, by = str(tmp_path), groups.by_value("year")
    with pytest.raises(ingest.EmptyBatch):
        ingest.ingest_changed_groups(frame(spark, []), root, SOURCE, by)
    assert ingest.ingest_changed_groups(frame(spark, []), root, SOURCE, by, on_empty="skip").status == "empty"
    ingest.ingest_changed_groups(frame(spark, FIRST), root, SOURCE, by, clock=clock(1))
    # a load that wrote its files and no manifest is never seen
    frame(spark, FIRST[:5]).write.parquet(f"{root}/batches/batch_ts=20990101_000000_000000")
    assert ingest.read_latest(spark, root).count() == len(FIRST)
    # loads by groups and whole loads may follow each other
    assert ingest.ingest_if_changed(frame(spark, FIRST[:9]), root, SOURCE, clock=clock(2)).status == "loaded"
    assert ingest.read_latest(spark, root).count() == 9 and ingest.landed_groups(spark, root) == ()
    assert len(ingest.ingest_changed_groups(frame(spark, FIRST[:9]), root, SOURCE, by, clock=clock(3)).groups) == 4
    assert audit.read_manifests(spark, f"{root}/manifests").count() == 3


def test_landing_a_statistic_by_period(spark, tmp_path):
    wide = "kode_provinsi string, nama_provinsi string, tahun int, jumlah_penduduk long"
    root = str(tmp_path)

    def deliver(years, size, hour):
        batch = spark.createDataFrame([(f"{p}00", f"P{p}", y, size * p) for p in (1, 2) for y in years], wide)
        return medallion.land_periods(batch, root, {**SOURCE}, expected=(2019, 2020, 2021), clock=clock(hour))

    with pytest.raises(medallion.MissingPeriods):
        deliver([2019, 2020], 10, 1)
    assert deliver([2019, 2020, 2021], 10, 2).groups == ("2019", "2020", "2021")
    assert deliver([2020], 11, 3).groups == ("2020",)
    found = {(r["tahun"], r["jumlah_penduduk"]) for r in ingest.read_latest(spark, root).where("kode_provinsi = '100'").collect()}
    assert found == {(2019, 10), (2020, 11), (2021, 10)}


def test_a_long_log_is_read_from_its_summary(spark, tmp_path):
    table = tmp_path / "t"
    versions.write_version(frame(spark, FIRST[:3]), str(table))
    entry = (table / "log" / "00000000.json").read_text()
    for at in range(1, 1008):
        (table / "log" / f"{at:08d}.json").write_text(entry.replace('"version": 0', f'"version": {at}') if at != 500 else "{half")
    versions.write_version(frame(spark, FIRST[:2]), str(table))
    assert versions.current_version(spark, str(table)) == 1008
    versions.write_version(frame(spark, FIRST[:1]), str(table))  # the thousand and tenth: the log is summarized
    log = versions.history(spark, str(table))
    assert len(log.inputFiles()) == 1 and log.count() == 1009
    for rows_left in (4, 5):
        versions.write_groups(frame(spark, FIRST[:rows_left]), str(table), groups.by_value("year"))
    log = versions.history(spark, str(table))
    assert len(log.inputFiles()) <= 10 and [r["version"] for r in log.tail(3)] == [1009, 1010, 1011]
    assert versions.read_version(spark, str(table)).count() == 5
    assert versions.read_version(spark, str(table), 1008).count() == 2 and versions.read_version(spark, str(table), 7).count() == 3
    # a damaged summary is ignored, by readers and by the next writer
    for part in (table / "log_summary").rglob("*.parquet"):
        part.write_bytes(part.read_bytes()[:100])
    for crc in (table / "log_summary").rglob("*.crc"):
        crc.unlink()
    log = versions.history(spark, str(table))
    assert log.count() == 1011 and len(log.inputFiles()) > 1000
    assert versions.write_version(frame(spark, FIRST[:6]), str(table)).version == 1012
    (table / "log_summary" / "latest.txt").write_text("what is this")
    assert versions.read_version(spark, str(table)).count() == 6
