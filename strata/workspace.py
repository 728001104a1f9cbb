"""Where intermediate tables live, and how lineage is cut.

A step whose result is read more than once is written as Parquet to the shared folder the
cluster names in ``spark.checkpoint.dir``. It survives lost executors, later reads prune
columns, and file sizes give the optimizer true sizes for its join choice.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this application."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
    return context.getCheckpointDir().rstrip("/")


def application_scratch(spark: SparkSession) -> str:
    """The folder below the scratch folder that only this application writes to."""
    return f"{scratch_root(spark)}/strata/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to."""
    return f"{application_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application stored below the scratch folder.

    For the end of a job: frames that read stored steps cannot be read any more.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(application_scratch(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*frames: DataFrame) -> None:
    """Delete the stored steps that the frames read, once all that is made of them is stored itself."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            folder = path(folder)
            if folder.getParent().getName() != spark.sparkContext.applicationId:
                raise ValueError(f"not a stored step: {folder}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
