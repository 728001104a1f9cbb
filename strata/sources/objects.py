"""Files as data: inventory, existence, size, small text objects, exclusive creation."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ObjectExists(Exception):
    """The object to be created is already there."""


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """The data files below ``path``: ``path, length, modification_time``, sorted by path.

    The file contents are not read: the scan prunes that column. Like any Spark scan it leaves out
    files without content and names that begin with ``_`` or ``.``; ``every_object`` has those too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path", "length", F.col("modificationTime").alias("modification_time")
    ).orderBy("path")


def every_object(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path`` without exception, in the columns and order of ``inventory``.

    The driver lists them one by one, so this is for folders of logs, manifests and the like.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    rows = []
    while found.hasNext():
        file = found.next()
        rows.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    schema = "path string, length bigint, _milliseconds bigint"
    listed = spark.createDataFrame(sorted(rows), schema)
    return listed.select("path", "length", F.timestamp_millis("_milliseconds").alias("modification_time")).orderBy("path")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there. Only absence gives False; other errors propagate."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def size(spark: SparkSession, path: str) -> DataFrame:
    """One row ``files, bytes`` for everything below ``path``."""
    return inventory(spark, path).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of one small text object, or None where it does not exist."""
    if not exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first()["value"]


def write_text(spark: SparkSession, path: str, text: str, exclusive: bool = False) -> None:
    """Store one small text object, whole or not at all.

    It is written under a name that scans pass over and then renamed. With ``exclusive`` the
    rename does not replace, so of two writers one succeeds and the other gets
    :class:`ObjectExists`.
    """
    fs_package = spark._jvm.org.apache.hadoop.fs
    target = fs_package.Path(path)
    draft = fs_package.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(fs_package, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE if exclusive else rename.OVERWRITE
    try:
        fs_package.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        cause = error.java_exception.getClass().getName()
        if exclusive and cause.endswith("FileAlreadyExistsException"):
            raise ObjectExists(path) from error
        raise
