"""Approximate nearest neighbours by inner product, in a tree of k-means clusters.

The tree is fitted on a bounded sample of the distinct vectors (``SAMPLE``); every vector is then
put into a leaf of it. A query walks the tree best bin first, with a priority queue of nodes by
the inner product with their centres, and so ranks the leaves. How many leaves a query visits is
calibrated: ``CALIBRATION`` sampled queries are answered by brute force over all vectors, and the
visits are widened until the leaves visited hold ``TARGET`` of their true neighbours. A walk goes on
beyond that until its leaves hold as many ids as an answer needs, or no leaf is left.

Equal vectors are one candidate with its smallest ids, as many as an answer can hold, so copies
neither crowd a leaf nor lose a tie. Vectors are compared in cells of at most about ``PART``: a query is
sent once to each cell that holds leaves of its walk, with the list of those leaves, and only
their vectors are its candidates. Cells with very many queries are copied.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component
take no part, as query or candidate, and neither do those of another length than most, nor rows
with a null id; rows with the same id and vector are one; an id with several vectors is a candidate
with each; ties go to the smaller id; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.blocks import lists, spans, table_path
from strata.workspace import materialize

SAMPLE = 16_384
BRANCH = 12
LEAF = 48  # sampled vectors that a leaf holds at most
CALIBRATION = 128
TARGET = 0.97
PART = 4096  # vectors of a cell: small leaves together, or a part of a large one
QUESTIONS = 1 << 16  # queries that one copy of a cell answers
WALK = 128  # queries that are compared at once
SPARE = 16  # candidates beyond the answer that are scored exactly, against rounding in products


class Tree(NamedTuple):
    """Centres of all nodes; children of inner nodes; leaves have a number."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray


def _k_means(points: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """The cluster of each point."""
    centres = points[random.choice(len(points), k, replace=False)]
    for _ in range(8):
        nearest = (points @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        centres = np.stack([points[nearest == i].mean(axis=0) if (nearest == i).any() else centres[i] for i in range(k)])
    return nearest


def fit_tree(points: np.ndarray) -> Tree:
    """Split the points into clusters, and those again, until a cluster fits into a leaf."""
    random = np.random.default_rng(7)
    centres, children, leaf = [points.mean(axis=0)], [[]], [-1]
    leaves, todo = 0, [(0, np.arange(len(points)))]
    while todo:
        node, mine = todo.pop()
        if len(mine) > LEAF:
            cluster = _k_means(points[mine], min(BRANCH, len(mine)), random)
            parts = [mine[cluster == i] for i in range(BRANCH) if (cluster == i).any()]
            if len(parts) > 1:
                for part in parts:
                    children[node].append(len(centres))
                    todo.append((len(centres), part))
                    centres.append(points[part].mean(axis=0))
                    children.append([])
                    leaf.append(-1)
                continue
        leaf[node] = leaves
        leaves += 1
    return Tree(np.stack(centres), children, np.array(leaf))


def place(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf of each point: the nearest child at every node on the way."""
    found = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, mine = todo.pop()
        if not tree.children[node]:
            found[mine] = tree.leaf[node]
            continue
        centres = tree.centres[tree.children[node]]
        nearest = (points[mine] @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        for i, child in enumerate(tree.children[node]):
            if (nearest == i).any():
                todo.append((child, mine[nearest == i]))
    return found


def best_bins(tree: Tree, query: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
    """The leaves in the order in which a best-bin-first walk reaches them: ``visits``, and on until their ``sizes`` reach ``least``."""
    near = (tree.centres @ query).tolist()
    queue, found, held = [(0.0, 0)], [], 0
    while queue and (len(found) < visits or held < least):
        _, node = heapq.heappop(queue)
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(queue, (-near[child], child))
        else:
            found.append(int(tree.leaf[node]))
            held += 0 if sizes is None else int(sizes[found[-1]])
    return found


def _matrix(column) -> np.ndarray:
    """The vectors of a list column, or of lists, as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else np.array(list(column), np.float64)
    return flat.reshape(len(column), -1)


def _best(query: np.ndarray, vectors: np.ndarray, reps: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query the k best vectors by exact score, then smaller id: (places, scores), by row.

    A score of minus infinity means none: fewer vectors, or not ``allowed`` (query by vector).
    """
    products = query @ vectors.T
    if allowed is not None:
        products[~allowed] = -np.inf
    n, most = products.shape[1], k + SPARE
    if n <= most:
        some = np.broadcast_to(np.arange(n), products.shape)
    else:
        some = np.argpartition(-products, most, axis=1)[:, :most]
        # equal products beyond the cut may be ties: then take them all, in every row
        edge = np.take_along_axis(products, some, axis=1).min(axis=1)
        limit = np.where(np.isfinite(edge), edge - 1e-12 * np.maximum(1.0, np.abs(edge)), np.inf)
        widest = int((products >= limit[:, None]).sum(axis=1).max())
        if widest > most and widest * query.size > 1 << 22 and len(query) > 1:  # very many ties: fewer queries at once
            half = len(query) // 2
            pairs = [_best(query[x], vectors, reps, k, None if allowed is None else allowed[x]) for x in (slice(0, half), slice(half, None))]
            return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        if widest > most:
            some = np.argpartition(-products, widest - 1, axis=1)[:, :widest]
    scores = (vectors[some] * query[:, None, :]).sum(axis=2)
    scores[~np.isfinite(np.take_along_axis(products, some, axis=1))] = -np.inf
    order = np.lexsort((reps[some], -scores), axis=1)[:, :k]
    return np.take_along_axis(some, order, axis=1), np.take_along_axis(scores, order, axis=1)


def deal_cells(counts: dict[int, int], leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """(first cell, number of cells) of each leaf: small leaves share a cell, large ones have several."""
    base, parts = np.zeros(leaves, np.int64), np.zeros(leaves, np.int64)
    cell = filled = 0
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if filled and filled + n > PART:
            cell, filled = cell + 1, 0
        base[leaf], parts[leaf] = cell, -(-n // PART)
        if n > PART:
            cell += int(parts[leaf])
        else:
            filled += n
    return base, parts


def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``vector`` (double) of the rows that take part."""
    vector = F.transform(F.col(embedding).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector")).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(fine).withColumn("length", F.size("vector"))
    usual = rows.groupBy("length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "length").limit(1)
    return rows.join(F.broadcast(usual.select("length")), "length").select("vec_id", "vector").distinct()


def search(df: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", target: float = TARGET) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k nearest of each row that ``is_query`` picks by ``vec_id``."""
    spark = df.sparkSession
    rows = materialize(usable(df, vec_id, embedding), "vectors")
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    distinct = least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = materialize(distinct.select(F.col("ids")[0].alias("rep"), "ids", "vector"), "distinct")
    # equal vectors of one id and others may share the smallest id; the place tells them apart
    sample = distinct.orderBy(F.xxhash64("vector"), "rep").limit(SAMPLE).select("vector").collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    tree = fit_tree(_matrix([r[0] for r in sample]))
    shared = spark.sparkContext.broadcast(tree)

    def leaves(batches):
        for batch in batches:
            if batch.num_rows:
                found = place(shared.value, _matrix(batch["vector"]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "leaf"])

    indexed = materialize(distinct.mapInArrow(leaves, "rep long, ids array<long>, vector array<double>, leaf long"), "index")
    asked = rows.where(is_query)
    questions = materialize(
        asked.select("vector").distinct().withColumn("question", F.monotonically_increasing_id()), "questions")
    visits = _calibrate(questions, indexed, tree, k, target)
    # one row per leaf, and the tree has no more of those than the sample has vectors
    counts = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    total = int(tree.leaf.max()) + 1
    base, parts = deal_cells(counts, total)
    filled = np.array([counts.get(leaf, 0) for leaf in range(total)], np.int64)
    enough = k + 1  # one may be the query's own
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def walk(batches):
        for whole in batches:
            for batch in (whole.slice(at, WALK) for at in range(0, whole.num_rows, WALK)):
                row, cell, first, leaf = [], [], [], []
                for i, vector in enumerate(_matrix(batch["vector"])):
                    found = np.array(best_bins(shared.value, vector, visits, filled, enough), np.int64)
                    mine = spans(base[found], parts[found])
                    order = np.argsort(mine, kind="stable")
                    leaf.append(np.repeat(found, parts[found])[order])
                    cells, sizes = np.unique(mine, return_counts=True)
                    row.append(np.full(len(cells), i))
                    cell.append(cells)
                    first.append(sizes)
                row = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cell)), batch["question"].take(row), batch["vector"].take(row),
                     lists(np.concatenate(leaf), np.concatenate(first), pa.int64())], ["cell", "question", "vector", "leaves"])

    bins = materialize(questions.repartition(tasks, "question").mapInArrow(
        walk, "cell long, question long, vector array<double>, leaves array<long>"), "bins")
    # a cell that very many queries visit is copied, once for each QUESTIONS of them
    copies = bins.groupBy("cell").agg(F.ceil(F.count("*") / QUESTIONS).cast("int").alias("copies"))
    left = bins.join(copies, "cell").select(
        "cell", F.pmod(F.xxhash64("question"), F.col("copies")).cast("int").alias("part"), F.lit(1).alias("kind"),
        F.col("question").alias("number"), "vector", F.col("leaves").alias("longs"))
    places = spark.createDataFrame(pd.DataFrame({"leaf": np.arange(len(base)), "base": base, "parts": parts}))
    placed = indexed.join(F.broadcast(places), "leaf").withColumn("cell", F.col("base") + F.pmod(F.xxhash64("vector"), F.col("parts")))
    right = placed.join(copies, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"), F.lit(0).alias("kind"),
        F.col("leaf").alias("number"), "vector", F.col("ids").alias("longs"))
    dealt = right.unionByName(left).repartition(tasks, "cell", "part").sortWithinPartitions("cell", "part", "kind")
    answers = dealt.mapInArrow(lambda batches: _compare(batches, k + 1), "question long, vec_id long, score double")

    top = Window.partitionBy("question").orderBy(F.desc("score"), "vec_id")
    merged = answers.withColumn("at", F.row_number().over(top)).where(F.col("at") <= k + 1).groupBy("question").agg(
        F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("found"))
    own = asked.withColumnRenamed("vec_id", "query_id").join(questions, "vector").select("query_id", "question").join(merged, "question")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def _compare(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k nearest of each query in each cell: a cell's vectors (kind 0) come before its queries."""
    key, held, data = None, [], ()
    for batch in batches:
        marks = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "part", "kind")], axis=1)
        edges = np.append(np.flatnonzero(np.append(True, (np.diff(marks, axis=0) != 0).any(axis=1))), len(marks))
        for a, b in zip(edges[:-1], edges[1:]):
            if key != tuple(marks[a][:2]):
                key, held, data = tuple(marks[a][:2]), [], ()
            if marks[a][2] == 0:
                held.append(batch.slice(a, b - a))
                continue
            if held:
                ids = pa.concat_arrays([x["longs"] for x in held])
                sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
                data = (np.concatenate([_matrix(x["vector"]) for x in held]), np.concatenate([x["number"].to_numpy() for x in held]),
                        ids.flatten().to_numpy(), np.cumsum(sizes) - sizes, sizes)
                held = []
            if not data:
                continue
            vectors, leaf, ids, at, sizes = data
            known, local = np.unique(leaf, return_inverse=True)
            for start in range(a, b, WALK):
                rows = batch.slice(start, min(WALK, b - start))
                asked, visited = _matrix(rows["vector"]), rows["longs"]
                lengths = pc.list_value_length(visited).to_numpy(zero_copy_only=False).astype(np.int64)
                place = np.searchsorted(known, visited.flatten().to_numpy())
                number = np.repeat(np.arange(len(asked)), lengths)
                fits = (place < len(known)) & (known[np.minimum(place, len(known) - 1)] == visited.flatten().to_numpy())
                allowed = np.zeros((len(asked), len(known)), bool)
                allowed[number[fits], place[fits]] = True
                best, scores = _best(asked, vectors, ids[at], k, allowed[:, local])
                row, column = np.nonzero(np.isfinite(scores))
                which, score = best[row, column], scores[row, column]
                counts = sizes[which]
                yield pa.RecordBatch.from_arrays(
                    [rows["number"].take(pa.array(np.repeat(row, counts))),
                     pa.array(ids[spans(at[which], counts)]), pa.array(np.repeat(score, counts))], ["question", "vec_id", "score"])


def _calibrate(questions: DataFrame, indexed: DataFrame, tree: Tree, k: int, target: float) -> int:
    """Leaves to visit so that sampled queries find ``target`` of their true neighbours."""
    sample = questions.orderBy(F.xxhash64("vector", F.lit(1)), "vector").limit(CALIBRATION).collect()
    if not sample:
        return 1
    vectors = questions.sparkSession.sparkContext.broadcast(_matrix([r["vector"] for r in sample]))

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                leaf, reps = batch["leaf"].to_numpy(zero_copy_only=False), batch["rep"].to_numpy(zero_copy_only=False)
                best, scores = _best(vectors.value, _matrix(batch["vector"]), reps, k + 1)
                query, place = np.repeat(np.arange(len(best)), best.shape[1]), best.ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query), pa.array(leaf[place]), pa.array(reps[place]), pa.array(scores.ravel())], ["query", "leaf", "rep", "score"])

    near = indexed.select("leaf", "rep", "vector").mapInArrow(scan, "query long, leaf long, rep long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).select("query", "leaf").collect()
    total = int(tree.leaf.max()) + 1
    ranks = [{leaf: i for i, leaf in enumerate(best_bins(tree, q, total))} for q in vectors.value]
    needed = sorted(ranks[r["query"]][r["leaf"]] for r in near)
    return needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)] + 1


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all ``embeddings``."""
    return search(spark.read.parquet(table_path(sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


QUERIES = {"op7_nearest": (op7_nearest, None)}
