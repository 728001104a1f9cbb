"""Dense surrogate keys 1..n in a given order, without sorting the table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.workspace import materialize

# monotonically_increasing_id keeps the position within the partition in its low 33 bits.
_POSITION_BITS = 33


def dense_key(df: DataFrame, name: str, order_by: Sequence[str], stored: bool = False) -> DataFrame:
    """Prepend ``name`` = 1..n in the order of ``order_by``, nulls last.

    The input is stored first, unless ``stored`` says that it is a plain scan of files that stay.
    It is range-partitioned on the full order, stored with each row's place in its partition, and
    shifted, when read, by the running count of the partitions before. Rows that tie in the order
    are placed by file position: equal copies, however many, spread over partitions, and a
    repeated task places its rows the same way.
    """
    columns = df.columns
    source = df if stored else materialize(df, f"{name}-input")
    located = source.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    order = [*[F.col(c).asc_nulls_last() for c in order_by], F.col("_file"), F.col("_row")]
    placed = located.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *columns, F.monotonically_increasing_id().alias("_slot")
    )
    placed = materialize(placed, f"{name}-placed")
    part = F.shiftright("_slot", _POSITION_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the table above: at most the number of shuffle partitions.
    offsets = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    shifted = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return shifted.select((F.col("_before") + position + 1).alias(name), *columns)
