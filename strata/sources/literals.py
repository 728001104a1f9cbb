"""Small tables given in the code."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table given in the code. It is a local relation, so the optimizer knows its size."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = zip(*rows) if rows else [()] * len(schema)
    arrays = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)
