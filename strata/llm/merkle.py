"""A Merkle manifest of a table: one root, and for each row a witness that it belongs to it.

Each row is a leaf: a SHA-256 over its fields, every field as ``-`` if null and otherwise its byte
count, ``:`` and its value. Leaves are ordered within their group (a source, say); every 16
consecutive nodes become a parent, until one node, the group's subroot, is left. The subroots in the order
of their groups are the leaves of a last tree like it, whose root seals the table.

Witnesses are built incrementally. Nodes are appended in order to the open run of their level; a
node's place in that run is its partial witness, shared by all leaves below it, and each sibling that
completes later extends it, since they share the run. A full run becomes a node of the next
level, where the same goes on (:class:`Appender`). Spark deals the leaves in aligned blocks of 4,096
to tasks; a block's root is appended to a tree of block roots in the next round, and so on until
one block holds a whole group. Then the witnesses of block roots go down to their blocks, one row a
block, where each leaf's own witness is completed with them. So no task holds more than a block,
however large a group is, and the number of rounds is the logarithm of the largest group to base 4,096.

Defined results: rows that tie in the order are ordered by their leaf; null order keys come last, the null group
comes first; each of several equal rows is a leaf of its own; a group of one row has its leaf as subroot; an
empty table has no root and gives no rows; columns of the input besides those named are not needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.blocks import table_path
from strata.operators.keys import dense_key
from strata.workspace import materialize

ARITY = 16
BLOCK_LEVELS = 3
BLOCK = ARITY**BLOCK_LEVELS

# The letters that tampering changes.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

WITNESS = "array<struct<place:int,beside:string>>"


def parent(digests: str) -> str:
    """The digest of a run, given its digests one after the other."""
    return hashlib.sha256(digests.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Run:
    """Siblings in order, and the run their parent stands in."""

    __slots__ = ("digests", "above", "place", "whole")

    def __init__(self):
        self.digests, self.above, self.place, self.whole = [], None, 0, ""

    def beside(self, place: int) -> str:
        """The siblings of the node at ``place``."""
        size = len(self.digests[0])
        return self.whole[: size * place] + self.whole[size * (place + 1) :]


class Appender:
    """A tree that grows leaf by leaf, and the witness of each leaf, which grows with it."""

    def __init__(self):
        self.levels: list[Run] = [Run()]
        self.leaves: list[tuple[Run, int]] = []

    def append(self, digest: str) -> None:
        """The next leaf."""
        self.leaves.append((self.levels[0], len(self.levels[0].digests)))
        self._push(0, digest)

    def _push(self, level: int, digest: str) -> None:
        run = self.levels[level]
        run.digests.append(digest)
        if len(run.digests) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run = self.levels[level]
        if len(self.levels) == level + 1:
            self.levels.append(Run())
        run.whole = "".join(run.digests)
        run.above, run.place = self.levels[level + 1], len(self.levels[level + 1].digests)
        self.levels[level] = Run()
        self._push(level + 1, parent(run.whole))

    def finish(self, levels: int) -> str:
        """Complete what is open below ``levels``; gives the one node of that level."""
        for level in range(levels):
            if self.levels[level].digests:
                self._complete(level)
        return self.levels[levels].digests[0]

    def witness(self, leaf: int) -> list[dict]:
        """Place and siblings of the leaf and of each node above it, as far as runs are complete."""
        steps = []
        run, place = self.leaves[leaf]
        while run is not None and run.whole:
            steps.append({"place": place, "beside": run.beside(place)})
            run, place = run.above, run.place
        return steps


def _grown(digests: Sequence[str], n: int) -> tuple[Appender, str]:
    """The tree over one block of a group of ``n`` nodes, and the block's root."""
    tree = Appender()
    for digest in digests:
        tree.append(digest)
    return tree, tree.finish(BLOCK_LEVELS if n > BLOCK else height(n))


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"position div {BLOCK}"))


def climb(nodes: DataFrame, most: int) -> list[DataFrame]:
    """The rounds from ``nodes`` (``gid, position, n, digest``) to one node a group; ``most`` is the largest n."""

    def root(block: pa.Table) -> pa.Table:
        block = block.sort_by("position")
        gid, number, n = (block[name][0].as_py() for name in ("gid", "block", "n"))
        _, digest = _grown(block["digest"].to_pylist(), n)
        return pa.table({"gid": [gid], "position": [number], "n": [-(-n // BLOCK)], "digest": [digest]})

    rounds = [nodes]
    while most > 1:
        dealt = _in_blocks(rounds[-1].select("gid", "position", "n", "digest"))
        above = dealt.groupBy("gid", "block").applyInArrow(root, "gid long, position long, n long, digest string")
        rounds.append(materialize(above, "block-roots"))
        most = -(-most // BLOCK)
    return rounds


def _completed(names: list[str]):
    """For a block and the one row with its root's witness and seal: the block's ``names``, witnesses and seal."""

    step = pa.struct([("place", pa.int32()), ("beside", pa.string())])

    def complete(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("position")
        rest, seal = above["witness"][0].as_py(), above["seal"][0].as_py()
        tree, _ = _grown(block["digest"].to_pylist(), block["n"][0].as_py())
        witnesses = [tree.witness(i) + rest for i in range(block.num_rows)]
        found = block.select(names).append_column("witness", pa.array(witnesses, pa.list_(step)))
        return found.append_column("seal", pa.array([seal] * block.num_rows, pa.string()))

    return complete


def descend(rounds: list[DataFrame], upper: DataFrame) -> DataFrame:
    """The columns of ``rounds[0]``, and each node's ``witness`` up to the root and on through ``upper``.

    ``upper`` has ``gid``, ``position`` 0, and the ``witness`` and ``seal`` of each group's root; the seal
    is handed on, since joining it to the witnesses would shuffle them.
    """
    for at in range(len(rounds) - 2, -1, -1):
        nodes = rounds[at]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
        blocks = _in_blocks(nodes).groupBy("gid", "block")
        above = upper.select("gid", F.col("position").alias("block"), "witness", "seal").groupBy("gid", "block")
        found = blocks.cogroup(above).applyInArrow(_completed(nodes.columns), f"{schema}, witness {WITNESS}, seal string")
        upper = materialize(found, "witnesses") if at else found
    if len(rounds) == 1:  # no group has a second node
        upper = rounds[0].join(upper.select("gid", "witness", "seal"), "gid")
    return upper


def leaf(columns: Sequence[Column]) -> Column:
    """The digest of a row's fields; numbers are written in decimal."""
    fields = []
    for column in columns:
        value = column.cast("string")
        fields.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def build(leaves: DataFrame, group: str, order_by: Sequence[str]) -> DataFrame:
    """``leaves`` with ``position``, ``subroot``, ``root`` and ``witness``.

    ``leaves`` has a column ``leaf``, the ``group`` and the columns of ``order_by``. A witness lists from the leaf
    to the root of the table the ``place`` of each node in its run and the digests ``beside`` it.
    """
    added = ("position", "subroot", "root", "witness")
    kept = [c for c in leaves.columns if c not in added]
    plain = {c: f"c{i}" for i, c in enumerate(kept)}
    renamed = leaves.select(*[F.col(f"`{c}`").alias(p) for c, p in plain.items()])
    known = renamed.withColumn("known", F.col(plain[group]).isNotNull())
    order = ["known", plain[group], *[plain[c] for c in order_by], plain["leaf"]]
    numbered = dense_key(known, "number", order)

    groups = numbered.groupBy("known", F.col(plain[group]).alias("name")).agg(F.min("number").alias("first"), F.count("*").alias("n"))
    groups = materialize(dense_key(groups, "gid", ["known", "name"]), "groups")
    shape = groups.agg(F.count("*").alias("groups"), F.max("n").alias("most")).first()
    located = numbered.join(groups.select("name", "first", "n", "gid"), F.col(plain[group]).eqNullSafe(F.col("name")))
    nodes = materialize(located.select(
        "gid", (F.col("number") - F.col("first")).alias("position"), "n", F.col(plain["leaf"]).alias("digest"), *plain.values()), "leaves")

    rounds = climb(nodes, shape["most"] or 0)
    subroots = rounds[-1].select(
        F.lit(0).cast("long").alias("gid"), (F.col("gid") - 1).alias("position"), F.lit(shape["groups"]).cast("long").alias("n"), "digest")
    tops = climb(subroots, shape["groups"])
    nothing = F.array().cast(WITNESS).alias("witness")
    roots = tops[-1].select("gid", "position", F.col("digest").alias("seal"), nothing)
    above = descend(tops, roots).select(
        (F.col("position") + 1).alias("gid"), F.lit(0).cast("long").alias("position"), F.col("digest").alias("seal"), "witness")
    found = descend(rounds, materialize(above, "subroots"))
    # the broadcast side is the one row of the table's root
    sealed = found.withColumnRenamed("seal", "subroot").join(F.broadcast(roots.select(F.col("seal").alias("root"))))
    return sealed.select(*[F.col(p).alias(c) for c, p in plain.items()], "position", "subroot", "root", "witness")


def proof(witness: Column) -> Column:
    """One digest over all siblings of a witness, from the leaf up."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: step["beside"]), "").cast("binary"), 256)


def fold(digest: Column, witness: Column) -> Column:
    """The root that follows from a leaf and its witness."""

    def up(below: Column, step: Column) -> Column:
        edge = step["place"] * 64
        return F.sha2(F.concat(
            F.substring(step["beside"], F.lit(1), edge), below, F.substring(step["beside"], edge + 1, F.length(step["beside"]))
        ).cast("binary"), 256)

    return F.aggregate(witness, digest, up)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` by source; where 5 divides the crc32 of the id the text is tampered with.

    A null id has no such number and is not tampered with.
    """
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    lowered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = documents.select(
        "doc_id", "source", leaf([F.col(c) for c in FIELDS]).alias("leaf"), F.when(tampered, leaf(lowered)).alias("forged"))
    found = build(leaves, "source", ["doc_id"])
    folded = found.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("witness")).alias("proof_sha256"),
        fold(F.coalesce("forged", "leaf"), F.col("witness")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(name: str, value: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE octet_length(encode({value}))::VARCHAR || ':' || {value} END"


def _leaf_sql(text: str) -> str:
    values = [text if c == "text" else f"{c}::VARCHAR" for c in FIELDS]
    return "sha256(" + " || ".join(_field_sql(c, v) for c, v in zip(FIELDS, values)) + ")"


# crc32 of a decimal number: its characters are bytes.
_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda h: ascii(h)::BIGINT),
  lambda c, v: xor(t[xor(c, v) % 256 + 1], c >> 8), 4294967295::BIGINT), 4294967295)"""
_SHIFT = "(CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END)"

OP12_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) AS s(i)
  UNION ALL SELECT i, k + 1, {_SHIFT.format("v")} FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS rid FROM (
    SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
      CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS forged
    FROM documents, crc_table)),
low AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM low WHERE n > 1 GROUP BY source, lvl, pos // {ARITY}),
subroots AS MATERIALIZED (
  SELECT source, digest, lvl AS levels, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, pos, n, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM high WHERE n > 1 GROUP BY lvl, pos // {ARITY}),
runs AS MATERIALIZED (
  SELECT source, lvl, pos // {ARITY} AS run, list(digest ORDER BY pos) AS d FROM low WHERE n > 1 GROUP BY ALL),
tops AS MATERIALIZED (SELECT lvl, pos // {ARITY} AS run, list(digest ORDER BY pos) AS d FROM high WHERE n > 1 GROUP BY ALL),
steps AS MATERIALIZED (
  SELECT l.rid, r.lvl, (l.pos // ({ARITY} ** r.lvl)::BIGINT) % {ARITY} AS place, r.d
  FROM leaves l JOIN runs r ON l.source IS NOT DISTINCT FROM r.source AND r.run = l.pos // ({ARITY} ** (r.lvl + 1))::BIGINT
  UNION ALL
  SELECT l.rid, s.levels + t.lvl, (s.pos // ({ARITY} ** t.lvl)::BIGINT) % {ARITY}, t.d
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
  JOIN tops t ON t.run = s.pos // ({ARITY} ** (t.lvl + 1))::BIGINT),
sides AS MATERIALIZED (
  SELECT rid, lvl, array_to_string(d[1 : place], '') AS before, array_to_string(d[place + 2 :], '') AS after FROM steps),
folds AS (
  SELECT rid, 0 AS lvl, coalesce(forged, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.rid, f.lvl + 1, sha256(before || digest || after) FROM folds f JOIN sides s ON f.rid = s.rid AND f.lvl = s.lvl),
folded AS (SELECT rid, arg_max(digest, lvl) AS folded_root FROM folds GROUP BY rid),
proofs AS (SELECT rid, sha256(string_agg(before || after, '' ORDER BY lvl)) AS proof_sha256 FROM sides GROUP BY rid)
SELECT doc_id, leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
JOIN folded USING (rid) LEFT JOIN proofs USING (rid)
CROSS JOIN (SELECT digest AS root FROM high WHERE n = 1)
"""

QUERIES = {"op12_merkle": (op12_merkle, OP12_SQL)}
