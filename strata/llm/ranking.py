"""Ranked lexical search: the best documents for each of a set of items, by presence masks.

Documents are read once into postings of the items' terms, from which the counts of the
weights follow. They are then searched block by block. In a block every term has a bitmap of the documents
that hold it and the highest impact it has on any of them. For an item, the bitmaps of its terms
are turned into one mask for each document, and documents with equal masks form a group: none of
them scores more than its terms' highest impacts add up to. Groups are scored in descending order of that
bound until the next bound is below the lowest of the item's best so far, which a task keeps
from block to block. Those of all tasks are ranked by a window that limits each task's rows first.

Items are taken in chunks of at most ``CHUNK_BYTES`` of text (or one item, if that alone is
longer), so what is broadcast and what reaches the driver stay bounded however many items there are;
each chunk is one pass over all documents, in blocks.

Defined results: null text has no terms, and neither have texts without a letter, digit or character
beyond ASCII; such documents count nowhere and such items have no rows; rows of items that are
equal in id and text are one item, those that only share an id are ranked each on its own; every row of the
documents is a document, repeated or not; among equal scores null ids come last; terms that
all documents hold weigh nothing; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.blocks import lists, spans, table_path, utf8
from strata.workspace import materialize

TOP = 10
CHUNK_BYTES = 2 << 20
FIRST_DOCUMENTS = 4 * TOP  # how many documents the groups scored first hold at least

# Which bytes belong to terms (ASCII letters and digits, all beyond ASCII), and lower case for A to Z.
FOLDED = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text, with repeats."""
    return text.translate(FOLDED).split()


def postings(documents: DataFrame, vocabulary: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """``doc_id``, number ``n`` of terms, and the known ``terms`` with ``counts``, of documents with any term."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n, sizes, terms, counts = [], [], [], []
            for body in batch["text"]:
                words = terms_of(body.as_buffer().to_pybytes())
                found = [(known[word], count) for word, count in Counter(words).items() if word in known]
                n.append(len(words))
                sizes.append(len(found))
                terms += [term for term, _ in found]
                counts += [count for _, count in found]
            sizes = np.array(sizes, np.int64)
            rows = pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), lists(np.array(terms, np.int32), sizes, pa.int32()),
                 lists(np.array(counts, np.int32), sizes, pa.int32())], ["doc_id", "n", "terms", "counts"])
            yield rows.filter(pa.array(np.array(n) > 0))

    return source.mapInArrow(run, POSTINGS)


class Block:
    """The postings of some documents, by term."""

    def __init__(self, batch: pa.RecordBatch, documents: int, length: int):
        self.size = batch.num_rows
        ids = batch["doc_id"]
        self.missing = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        n = batch["n"].to_numpy()
        terms, counts = batch["terms"], batch["counts"]
        slot = np.repeat(np.arange(self.size), np.diff(terms.offsets.to_numpy()))
        term, count = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
        order = np.argsort(term, kind="stable")
        term, slot, count = term[order], slot[order], count[order]
        m = 100 - 90 + 90 * n * documents // length
        self.impacts = 1_000_000_000 * count // (1000 * count + 8 * m[slot])
        first = np.flatnonzero(np.diff(term, prepend=-1))
        self.terms = term[first]
        row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(term))))
        self.places = row * self.size + slot  # ascending
        self.highest = np.maximum.reduceat(self.impacts, first) if len(first) else np.zeros(0, np.int64)
        width = -(-self.size // 8)
        bitmaps = np.zeros(len(first) * width, np.uint8)
        np.bitwise_or.at(bitmaps, row * width + slot // 8, (128 >> slot % 8).astype(np.uint8))
        self.bitmaps = bitmaps.reshape(len(first), width)

    def groups(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mask bits of each group, its first place in the order, documents in the order of groups) for some terms."""
        present = np.unpackbits(self.bitmaps[rows], axis=1, count=self.size)
        packed = np.packbits(present, axis=0)
        words = np.zeros((self.size, -(-len(packed) // 8) * 8), np.uint8)
        words[:, : len(packed)] = packed.T
        words = words.view(np.uint64)
        order = np.argsort(words[:, 0], kind="stable") if words.shape[1] == 1 else np.lexsort(words.T)
        ordered = words[order]
        first = np.flatnonzero(np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1)))
        return present[:, order[first]], first, order

    def scores(self, rows: np.ndarray, weights: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """The scores of some documents for the terms in ``rows``."""
        present = np.unpackbits(self.bitmaps[rows], axis=1, count=self.size)[:, documents]
        term, at = np.nonzero(present)
        impact = self.impacts[np.searchsorted(self.places, rows[term] * self.size + documents[at])]
        total = np.zeros(len(documents), np.int64)
        np.add.at(total, at, weights[term] * impact)
        return total


class Best:
    """The best documents seen for one item: highest score, then smallest id, null ids last."""

    __slots__ = ("scores", "ids", "missing", "top")

    def __init__(self, top: int):
        self.scores = self.ids = np.zeros(0, np.int64)
        self.missing, self.top = np.zeros(0, bool), top

    @property
    def least(self) -> int:
        """No document below this score can come in."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        missing = np.append(self.missing, missing)
        order = np.lexsort((ids, missing, -scores))
        order = order[scores[order] > 0][: self.top]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def search_block(block: Block, rows: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Bring into ``best`` what the block has for an item's terms; gives the number of documents scored."""
    masks, first, order = block.groups(rows)
    bounds = (weights * block.highest[rows]) @ masks.astype(np.int64)
    ranked = np.argsort(-bounds, kind="stable")
    bounds, begin = bounds[ranked], first[ranked]
    sizes = np.diff(np.append(first, block.size))[ranked]
    held = np.cumsum(sizes)
    done, share = 0, FIRST_DOCUMENTS
    while True:
        # groups that may still matter, a larger share of them at each turn
        open_groups = int(np.searchsorted(-bounds, -best.least, side="right"))
        until = min(open_groups, int(np.searchsorted(held, (held[done - 1] if done else 0) + share)) + 1)
        if until <= done:
            return int(held[done - 1]) if done else 0
        documents = order[spans(begin[done:until], sizes[done:until])]
        best.add(block.scores(rows, weights, documents), block.ids[documents], block.missing[documents])
        done, share = until, 2 * share


def best_documents(
    stored: DataFrame, items: list[np.ndarray], weights: np.ndarray, documents: int, length: int, top: int,
) -> DataFrame:
    """``item`` (place in ``items``), ``doc_id`` and ``score``: the best of each task for each item."""
    shared = stored.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best = [Best(top) for _ in items]
        row_of = np.full(len(weights), -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            block = Block(batch, documents, length)
            row_of[block.terms] = np.arange(len(block.terms))
            for terms, found in zip(items, best):
                here = terms[(row_of[terms] >= 0) & (weights[terms] > 0)]
                if len(here):
                    search_block(block, row_of[here], weights[here], found)
            row_of[block.terms] = -1
        for item, found in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found.ids), item, np.int32)), pa.array(found.ids, mask=found.missing), pa.array(found.scores)],
                ["item", "doc_id", "score"])

    return stored.mapInArrow(run, FOUND)


def _chunked(items: DataFrame, chunk_bytes: int) -> tuple[DataFrame, int]:
    """The items with a number ``chunk``, and how many chunks there are: none is larger than allowed."""
    hashed = F.xxhash64("item_id", "text")
    chunks = 1
    while True:
        found = items.withColumn("chunk", F.pmod(hashed, F.lit(chunks)))
        large = found.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
        if large.where((F.col("bytes") > chunk_bytes) & (F.col("n") > 1)).isEmpty():
            return found, chunks
        chunks *= 2


def rank(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the ``top`` documents of each item with a score above 0."""
    spark = documents.sparkSession
    distinct = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    distinct = materialize(distinct.where("text IS NOT NULL"), "items")
    chunked, chunks = _chunked(distinct, chunk_bytes)
    kind = distinct.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for chunk in range(chunks):
        rows = [r for r in chunked.where(F.col("chunk") == chunk).select("item_id", "text").collect()]
        found_terms = [sorted(set(terms_of(r["text"].encode()))) for r in rows]
        vocabulary = {term: i for i, term in enumerate(sorted(set().union(*found_terms)))}
        if not vocabulary:
            continue
        stored = materialize(postings(documents, vocabulary, doc_id, text), "postings")
        totals = stored.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        n, length = totals["documents"], totals["length"] or 0
        if not n:
            continue
        # at most one row a term of the chunk
        holding = dict(map(tuple, stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
        terms = [np.array([vocabulary[t] for t in each], np.int64) for each in found_terms]
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = best_documents(stored, terms, weights, n, length, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ranked = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        found = found.unionByName(ranked if chunks == 1 else materialize(ranked, "ranked"))
    return found


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each ``benchmark`` item."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    return rank(documents, spark.read.parquet(table_path(sf_dir, "benchmark")))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
known AS (SELECT row, doc_id, terms, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM known),
counted AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM known) GROUP BY row, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counted, totals GROUP BY term, docs),
items AS (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
asked AS (SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest({_TERMS}) AS term FROM items)),
scored AS (
  SELECT item, item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // length)))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN known USING (row), totals
  GROUP BY item, item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

QUERIES = {"op13_ranked_search": (op13_ranked_search, OP13_SQL)}
