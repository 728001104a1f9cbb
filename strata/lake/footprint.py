"""How much room a dataset takes in each layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import literal_table
from strata.sources.objects import exists, inventory

LAYERS = ("bronze", "silver", "gold")


def footprint(spark: SparkSession, datasets: Mapping[str, Mapping[str, str | None]]) -> DataFrame:
    """Per dataset the bytes in each layer and ``bronze / silver`` as compression ratio.

    ``datasets`` maps a name to its path per layer. A layer without a path, or whose path does not
    exist, has null bytes; the ratio is then null.
    """
    names = literal_table(spark, [(name,) for name in datasets], "dataset string")
    parts = [
        inventory(spark, path).select(F.lit(name).alias("dataset"), F.lit(layer).alias("layer"), "length")
        for name, layers in datasets.items()
        for layer, path in layers.items()
        if path is not None and exists(spark, path)
    ]
    if not parts:
        sizes = names.withColumns({layer: F.lit(None).cast("bigint") for layer in LAYERS})
    else:
        files = reduce(DataFrame.unionByName, parts)
        sizes = names.join(
            files.groupBy("dataset").pivot("layer", list(LAYERS)).agg(F.sum("length")), "dataset", "left"
        )
    ratio = F.try_divide(F.col("bronze").cast("double"), F.col("silver"))
    return sizes.select(
        "dataset", *[F.col(layer).alias(f"{layer}_bytes") for layer in LAYERS],
        F.round(ratio, 1).alias("compression_ratio"),
    ).orderBy("dataset")
