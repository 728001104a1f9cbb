"""Sharding by a keyed permutation of global row numbers.

Every row gets a number 0..n-1 in a stated order. A Feistel network permutes a grid of at least n
cells, the smallest that is about square; a result outside 0..n-1 is put through again until
it is inside (cycle walking), which makes it a permutation of 0..n-1. Cell p is slot ``p div
shards`` of shard ``p mod shards``: counts differ by at most one, slots have no gaps, the shuffle
depends on seed and order alone, and the place of any row number, or the row number at any place,
is a formula that needs no table (``Permutation.place``, ``Permutation.row``).

Everything is DataFrame expressions in 64-bit integers; no Python runs on executors. Fewer than
sqrt(n) cells of the grid lie outside, so nearly no row walks; how many steps the longest walk has is
found beforehand by walking those outside cells, and that many are part of the expression.

Defined results: every row, repeated or not, is a row of its own with a place of its own; null values
come last in the order; rows that tie in the whole order are placed by file position, so they
may swap places with each other and nothing else; columns of the input named like the new ones are
replaced; an empty table gives an empty table; with more shards than rows, some shards are empty.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm.blocks import table_path, utf8
from strata.operators.keys import dense_key
from strata.workspace import materialize

SHARDS = 8
SEED = 20240611
ROUNDS = 6  # even, so that both halves have their own size again
ADDED = ("row_number", "shard", "slot")

_PRIME = (1 << 31) - 1


def _constants(seed: int) -> list[tuple[int, int, int]]:
    """For each round two factors and a summand below 2^31, from the seed by a congruential generator."""
    state, found = seed & (1 << 64) - 1, []
    for _ in range(3 * ROUNDS):
        state = (state * 6364136223846793005 + 1442695040888963407) & (1 << 64) - 1
        found.append((state >> 33) % (_PRIME - 1) + 1)
    return list(zip(found[::3], found[1::3], found[2::3]))


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0..n-1 chosen by ``seed``, for n up to 2^60."""

    n: int
    seed: int = SEED

    def __post_init__(self):
        if not 0 <= self.n <= 1 << 60:
            raise ValueError(f"cannot permute {self.n} rows")

    @property
    def sides(self) -> tuple[int, int]:
        """The grid's two sides: their product is at least n, by less than one side."""
        left = max(1, math.isqrt(max(self.n - 1, 0)) + 1)
        return left, max(1, -(-self.n // left))

    @property
    def cells(self) -> int:
        left, right = self.sides
        return left * right

    @staticmethod
    def _mix(x: int, constants: tuple[int, int, int]) -> int:
        """The round function."""
        first, summand, second = constants
        x = (x * first + summand) % _PRIME
        x = (x ^ x >> 15) * second % _PRIME
        return x ^ x >> 13

    def _step(self, cell: int) -> int:
        left, right = self.sides
        a, b = divmod(cell, right)
        for constants in _constants(self.seed):
            a, b = b, (a + self._mix(b, constants)) % left
            left, right = right, left
        return a * right + b

    def _step_back(self, cell: int) -> int:
        left, right = self.sides
        a, b = divmod(cell, right)
        for constants in reversed(_constants(self.seed)):
            left, right = right, left
            a, b = (b - self._mix(a, constants)) % left, a
        return a * right + b

    def place(self, row_number: int, shards: int = SHARDS) -> tuple[int, int]:
        """Shard and slot of a row number."""
        cell = self._step(row_number)
        while cell >= self.n:
            cell = self._step(cell)
        return cell % shards, cell // shards

    def row(self, shard: int, slot: int, shards: int = SHARDS) -> int:
        """The row number at a place."""
        cell = self._step_back(slot * shards + shard)
        while cell >= self.n:
            cell = self._step_back(cell)
        return cell

    def step(self, cell: Column) -> Column:
        """Where the network sends a cell. The rounds run over an array of their constants, so the
        expression stays small wherever the optimizer copies it."""
        left, right = self.sides
        rounds = F.array(*[
            F.struct(F.lit(first).alias("first"), F.lit(summand).alias("summand"), F.lit(second).alias("second"),
                     F.lit(right if at % 2 else left).alias("side"))
            for at, (first, summand, second) in enumerate(_constants(self.seed))
        ])

        def mixed(b: Column, constants: Column) -> Column:
            x = (b * constants["first"] + constants["summand"]) % _PRIME
            x = x.bitwiseXOR(F.shiftright(x, 15)) * constants["second"] % _PRIME
            return x.bitwiseXOR(F.shiftright(x, 13))

        def pair(a: Column, b: Column) -> Column:
            return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

        return F.aggregate(
            rounds, pair(F.call_function("div", cell, F.lit(right)), cell % right),
            lambda at, constants: pair(at["b"], (at["a"] + mixed(at["b"], constants)) % constants["side"]),
            lambda at: at["a"] * right + at["b"],
        )

    def longest_walk(self, spark: SparkSession) -> int:
        """The most steps that any row needs after its first, found by walking the cells outside."""
        walks, walking = 0, spark.range(self.n, self.cells).select(F.col("id").alias("start"), F.col("id").alias("cell"))
        while not walking.isEmpty():
            walks += 1
            walked = materialize(walking.withColumn("cell", self.step(F.col("cell"))), "walk")
            # a cycle that only has cells outside closes; no row is on it
            walking = walked.where((F.col("cell") >= self.n) & (F.col("cell") != F.col("start")))
        return walks

    def cell(self, row_number: Column, walks: int) -> Column:
        """Where a row number is sent; ``walks`` is the longest walk."""
        first = self.step(row_number)
        if not walks:
            return first
        more = F.array(*[F.lit(i) for i in range(walks)])
        return F.aggregate(more, first, lambda at, _: F.when(at < self.n, at).otherwise(self.step(at)))


def shard_rows(df: DataFrame, order_by: Sequence[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number`` (from 0, in the order of ``order_by``), ``shard`` and ``slot``.

    What follows from it is reproducible as far as ``order_by`` tells rows apart. The columns of ``df``
    are shuffled once and stored, so leave out what is not needed.
    """
    if shards < 1:
        raise ValueError(f"cannot fill {shards} shards")
    kept = [c for c in df.columns if c not in ADDED or c in order_by]
    plain = [f"c{i}" for i in range(len(kept))]  # whatever the input calls its columns
    renamed = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(kept, plain)])
    numbered = dense_key(renamed, "row_number", [plain[kept.index(c)] for c in order_by])
    numbered = numbered.withColumn("row_number", F.col("row_number") - 1)
    permutation = Permutation(numbered.count(), seed)
    sent = numbered.withColumn("_cell", permutation.cell(F.col("row_number"), permutation.longest_walk(df.sparkSession)))
    return sent.select(
        *[F.col(p).alias(c) for c, p in zip(kept, plain) if c not in ADDED], "row_number",
        (F.col("_cell") % shards).cast("int").alias("shard"), F.expr(f"_cell div {shards}").alias("slot"),
    )


def write_shards(
    df: DataFrame, path: str, order_by: Sequence[str], shards: int = SHARDS, seed: int = SEED, rows_per_file: int = 1 << 20,
) -> None:
    """Write ``df`` as Parquet below ``path/shard=k``, each file a run of slots in order."""
    placed = shard_rows(df, order_by, shards, seed)
    run = F.expr(f"slot div {rows_per_file}")
    files = placed.repartition("shard", run).sortWithinPartitions("shard", "slot")
    files.write.partitionBy("shard").parquet(path)


def op11_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of ``documents``, by the law ``rows``: counts differ by at most one."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    text = utf8("text")
    rows = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest"))
    placed = shard_rows(rows, ["doc_id", "size", "text_crc32", "digest"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def _mixed_sql(constants: tuple[int, int, int]) -> str:
    """The round function of ``b`` in SQL."""
    first, summand, second = constants
    x = f"((b * {first} + {summand}) % {_PRIME})"
    x = f"(xor({x}, {x} >> 15) * {second} % {_PRIME})"
    return f"xor({x}, {x} >> 13)"


def _network_sql() -> str:
    """CTEs r0..r6: the grid's coordinates of ``cell`` after each round, in each step of a walk."""
    return "\n".join(
        f"r{i + 1} AS MATERIALIZED (SELECT x, b AS a, (a + {_mixed_sql(c)}) % {'lft' if i % 2 == 0 else 'rgt'} AS b, lft, rgt FROM r{i}),"
        for i, c in enumerate(_constants(SEED))
    )


# The network over the whole grid is a table of x and its image; a recursive walk follows it.
OP11_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, {reduce(lambda v, _: f"(CASE WHEN {v} % 2 = 1 THEN xor({v} >> 1, 3988292384) ELSE {v} >> 1 END)", range(2), "w")} AS v FROM (
    SELECT i, {reduce(lambda v, _: f"(CASE WHEN {v} % 2 = 1 THEN xor({v} >> 1, 3988292384) ELSE {v} >> 1 END)", range(3), "u")} AS w FROM (
    SELECT i, {reduce(lambda v, _: f"(CASE WHEN {v} % 2 = 1 THEN xor({v} >> 1, 3988292384) ELSE {v} >> 1 END)", range(3), "i")} AS u
    FROM range(256) AS s(i))))),
rows_in AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5(coalesce(text, '')) AS digest,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, v: xor(t[xor(c, v) % 256 + 1], c >> 8), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM documents, crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32, digest) - 1 AS row_number FROM rows_in),
grid AS (SELECT n, lft, ((n + lft - 1) // lft)::BIGINT AS rgt FROM (SELECT n, (floor(sqrt(n - 1)) + 1)::BIGINT AS lft FROM (SELECT count(*) AS n FROM documents))),
r0 AS MATERIALIZED (SELECT x, x // rgt AS a, x % rgt AS b, lft, rgt FROM (SELECT unnest(range(lft * rgt)) AS x, lft, rgt FROM grid)),
{_network_sql()}
image AS MATERIALIZED (SELECT x, a * rgt + b AS y FROM r{ROUNDS}),
walk AS (
  SELECT row_number, y AS cell FROM numbered JOIN image ON x = row_number
  UNION ALL
  SELECT row_number, y FROM walk JOIN image ON x = cell WHERE cell >= (SELECT n FROM grid))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (cell % {SHARDS})::INT AS shard,
  (cell // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, row_number
FROM numbered JOIN walk USING (row_number) WHERE cell < (SELECT n FROM grid)
"""

QUERIES = {"op11_sharding": (op11_sharding, OP11_SQL)}
