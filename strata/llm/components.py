"""Connected components of an edge table, by alternating star steps.

Each step is a grouped minimum and a join, so a hub with most of the edges is pre-aggregated
before the shuffle and split by the skew join after it. Steps are stored in the shared scratch
folder, which also cuts lineage. The number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.workspace import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest node around."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch as stars around the smallest node of each of its components."""
    for batch in batches:
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
            x, y = find(u), find(v)
            if x != y:
                parent[max(x, y)] = min(x, y)
        found = [(u, find(u)) for u in parent]
        kind = batch.schema.field("u").type
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found if f[0] != f[1]], kind) for i in (0, 1)], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    ``edges`` has two columns of equal type. Null ends, loops and repeated edges are ignored; no
    edges give an empty result.
    """
    a, b = edges.columns
    stars = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    current, mark = materialize(stars.mapInArrow(local_forest, stars.schema), "edges"), None
    while True:
        following = materialize(_small_star(_large_star(current)), "stars")
        seen = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(current)
        current = following
        if mark == tuple(seen) or not seen[0]:
            break
        mark = tuple(seen)
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
