"""Preparing a session for this package: its source on the executors, and batches of bounded size."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
# Rows that go to a Python worker at once. Whole texts are some kilobytes each, and a batch of them
# is held several times: by Spark, on its way, and by the worker.
BATCH_ROWS = 2048


def ship(spark: SparkSession) -> None:
    """Add the library's source to the application's Python files, once per application.

    Workers that cannot import it themselves find it there. Also sets the session's batch size.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="strata-source-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so once the driver's JVM has collected what refers to them, which a driver with much
    memory and little to do puts off while the executors' disks fill.
    """
    spark._jvm.System.gc()


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, run after the package was sent to the executors and earlier steps' files were released."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        release(spark)
        return query(spark, *args)

    return run
