"""CSV from elsewhere: bound by header, right or refused."""

import gzip

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.plans import medallion
from strata.sources import files, foreign
from strata.sources.responses import BINDING_COLUMNS

COLUMNS = ["id", "name"]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path.parent)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_are_bound_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n1,x\n")
    write(tmp_path / "b c.csv", "﻿name,id\r\ny,2\r\n\r\n")
    write(tmp_path / "c.csv", 'more,"name",id\n?,"z, ""z""",3\n')
    path = write(tmp_path / "d.csv", "")
    assert rows(files.read_csv(spark, path, COLUMNS)) == [("1", "x"), ("2", "y"), ("3", 'z, "z"')]
    assert rows(files.read_csv(spark, path, ["name"])) == [("x",), ("y",), ('z, "z"',)]
    assert files.read_csv(spark, path).columns == COLUMNS  # those of the first file
    with pytest.raises(foreign.UnreadableSource, match="not expected"):
        files.read_csv(spark, path, COLUMNS, extra="refuse")
    with pytest.raises(foreign.UnreadableSource, match="missing"):
        files.read_csv(spark, path, [*COLUMNS, "more"])
    assert rows(files.read_csv(spark, path, [*COLUMNS, "more"], missing="null")) == [("1", "x", None), ("2", "y", None), ("3", 'z, "z"', "?")]


def test_repeated_names_and_headers(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,id,name\n1,2,x\nid,id,name\n3,4,y\n")
    assert rows(files.read_csv(spark, path, ["name"])) == [("x",), ("y",)]
    with pytest.raises(foreign.UnreadableSource, match="twice"):
        files.read_csv(spark, path, COLUMNS)


def test_cells_with_line_breaks_are_right_or_refused(spark, tmp_path):
    """The middle line of the cell would pass for a record of its own."""
    write(tmp_path / "a.csv", 'id,name\n1,"two\nx,y\nlines"\n2,z\n')
    path = write(tmp_path / "b.csv", "name,id\nw,3\n")
    with pytest.raises(PySparkException, match="line break"):
        files.read_csv(spark, path, COLUMNS).collect()
    read = files.read_csv(spark, path, COLUMNS, multiline=True)
    assert rows(read) == [("1", "two\nx,y\nlines"), ("2", "z"), ("3", "w")] and read.count() == 3
    # only the file with line breaks is read whole
    scan = foreign.scan_csv(spark, path, COLUMNS, multiline=True)
    plan = scan.rows._jdf.queryExecution().toString()
    assert "a.csv" in plan and plan.count("Relation [value") >= 1


def test_rejected_records(spark, tmp_path):
    write(tmp_path / "a.csv", "id,name\n1,x\n2\n3,y,?\n")
    write(tmp_path / "b.csv", 'name,id\n"t\nu",4\nlone\n')
    path = write(tmp_path / "c.csv", 'id,name\n5,"never closed\n6,v\n')
    scan = foreign.scan_csv(spark, path, COLUMNS, multiline=True)
    assert rows(scan.rows) == [("1", "x"), ("4", "t\nu")]
    found = {(r["path"].rsplit("/", 1)[1], (r["record"] or "").strip(), r["reason"]) for r in scan.rejected.collect()}
    assert found == {("a.csv", "2", "cells"), ("a.csv", "3,y,?", "cells"), ("b.csv", "lone", "cells"), ("c.csv", "", "quotes")}
    assert scan.rejected.count() == 4 and scan.rows.count() == 2
    with pytest.raises(foreign.UnreadableSource, match="pair up"):
        files.read_csv(spark, path, COLUMNS, multiline=True)
    ragged = write(tmp_path / "ragged" / "a.csv", "id,name\n1,x\n2\n")
    with pytest.raises(PySparkException, match="not the cells of its header"):
        files.read_csv(spark, ragged, COLUMNS).count()


def test_compressed_and_quoted_headers(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'"id","na""me"\n1,x\n'))
    assert files.read_csv(spark, str(tmp_path)).columns == ["id", 'na"me']
    path = write(tmp_path / "broken" / "a.csv", 'id,"na\nme"\n1,x\n')
    with pytest.raises(foreign.UnreadableSource, match="header has a line break"):
        files.read_csv(spark, path)
    read = files.read_csv(spark, path, multiline=True)
    assert read.columns == ["id", "na\nme"] and rows(read) == [("1", "x")]


def test_sources_without_records(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name\n")
    assert rows(files.read_csv(spark, path, COLUMNS)) == []
    hollow = write(tmp_path / "none" / "a.csv", "")
    assert files.read_csv(spark, hollow, COLUMNS).columns == COLUMNS
    with pytest.raises(foreign.UnreadableSource, match="header"):
        files.read_csv(spark, hollow)
    scan = foreign.scan_csv(spark, hollow, COLUMNS, multiline=True)
    assert rows(scan.rows) == rows(scan.rejected) == []


def test_fallback_by_header(spark, tmp_path):
    alternate = write(tmp_path / "alt" / "a.csv", 'name,id\n"x\ny",1\n')
    ragged = write(tmp_path / "primary" / "a.csv", "id,name\n1\n")
    assert rows(files.read_with_fallback(spark, ragged, alternate, COLUMNS, multiline=True)) == [("1", "x\ny")]
    other = write(tmp_path / "other" / "a.csv", "id,title\n1,t\n")
    assert rows(files.read_with_fallback(spark, other, alternate, COLUMNS, multiline=True)) == [("1", "x\ny")]
    own = str(tmp_path / "own")
    files.write_csv(spark.createDataFrame([("1", "x\ny\\n")], "id string, name string"), own)
    assert rows(files.read_with_fallback(spark, str(tmp_path / "no"), own, COLUMNS, escaped=True)) == [("1", "x\ny\\n")]


def test_other_failures_are_raised(spark):
    """A division by zero is no unreadable source."""
    with pytest.raises(PySparkException):
        files.first_usable(lambda: spark.range(3).select(F.col("id") / F.lit(0)).where("`(id / 0)` > 1"))
    assert files.first_usable(lambda: spark.read.parquet("/nowhere/at/all")) is None


def test_entities_from_a_foreign_fallback(spark, tmp_path):
    names = list(BINDING_COLUMNS.values())
    header, record = ",".join(reversed(names)), ",".join(f"v{i}" for i in reversed(range(len(names))))
    path = write(tmp_path / "a.csv", f"{header},more\n{record},?\n")
    found = medallion.entity_batch(spark, str(tmp_path / "no"), path)
    assert found.columns == names and rows(found) == [tuple(f"v{i}" for i in range(len(names)))]
