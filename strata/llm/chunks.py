"""Substring deduplication by content-defined chunks.

A gear hash rolls over the last 16 bytes of a text; where its top bits are zero a chunk ends, so
an insertion moves only the borders near it. Chunks are compared by digest. The first occurrence
(smallest id, then position) stays. Later ones are removed where a run of neighbouring repeated
chunks reaches ``MIN_RUN`` bytes, which keeps short phrases that merely recur.

Defined results: null text counts as empty and keeps its row; rows are told apart by id and
digest of the text, so repeated equal rows get equal results and are not compared with each other;
a null id is an id like any other and comes first; among equal chunks the order is id, digest,
position; removed spans are in bytes of the UTF-8 text and never split a character; an empty table
gives an empty table. Input columns other than id and text are neither needed nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.blocks import flat_bytes, lists, slices, table_path, utf8
from strata.llm.shipping import release
from strata.workspace import discard, materialize

CUT_BITS = 5  # a border every 32 bytes on average, besides the least length
LEAST = 16
MOST = 128
MIN_RUN = 96

_RANDOM = np.random.default_rng(1)
GEAR = _RANDOM.integers(0, 1 << 16, 256, dtype=np.uint16)
DIGEST_SEED = 1
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def gear_hash(flat: np.ndarray) -> np.ndarray:
    """At each byte the 16-bit gear hash of the 16 bytes that end there."""
    rolled = GEAR[flat]
    for width in (1, 2, 4, 8):
        shifted = np.zeros_like(rolled)
        shifted[width:] = rolled[:-width] << np.uint16(width) if len(rolled) > width else 0
        rolled = rolled + shifted
    return rolled


def chunk_starts(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First byte of every chunk of every text (offsets ``at``), in order."""
    if not len(flat):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(gear_hash(flat) >> np.uint16(16 - CUT_BITS) == 0) + 1
    ends = ends[ends < len(flat)]
    row = np.searchsorted(at, ends, side="right") - 1
    # a border too near the beginning or end of its text is none: the hash of the others covers bytes
    # of their own text only, so what stands before a text in its block decides nothing
    inside = (ends - at[row] >= LEAST) & (at[row + 1] - ends >= LEAST)
    ends, row = ends[inside], row[inside]
    # nor is one too near the border before it in the same text
    apart = np.ones(len(ends), bool)
    apart[1:] = (np.diff(ends) >= LEAST) | (row[1:] != row[:-1])
    ends = ends[apart]
    starts = np.sort(np.concatenate([at[:-1][np.diff(at) > 0], ends]))
    lengths = np.diff(np.append(starts, len(flat)))
    pieces = -(-lengths // MOST)
    if (pieces > 1).any():  # long stretches without a border
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + inner * MOST
    lead = (flat[starts] & 0xC0) == 0x80
    while lead.any():  # never inside a character
        starts = starts - lead
        lead = (flat[starts] & 0xC0) == 0x80
    return starts


def row_digest(text: str) -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64(utf8(text))


def _cut(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, length, digest) of every chunk of a block of texts."""
    body = flat.tobytes()
    starts = chunk_starts(flat, at)
    ends = np.append(starts[1:], len(flat))
    digest = xxhash.xxh3_64_intdigest
    found = np.fromiter((digest(body[a:b], DIGEST_SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    return starts, ends - starts, found.view(np.int64)


def chunks(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``row_digest``, ``start``, ``length`` and ``digest`` of every chunk."""
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), row_digest(text).alias("row_digest"), utf8(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            flat, at = flat_bytes(batch["__text"])
            starts, lengths, digests = _cut(flat, at)
            row = np.searchsorted(at, starts, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row)), batch["row_digest"].take(pa.array(row)),
                 pa.array((starts - at[row]).astype(np.int32)), pa.array(lengths.astype(np.int32)), pa.array(digests)],
                ["doc_id", "row_digest", "start", "length", "digest"],
            )

    return source.mapInArrow(run, "doc_id long, row_digest long, start int, length int, digest long")


def recurring_digests(df: DataFrame, text: str) -> DataFrame:
    """``digest`` of every chunk that occurs more than once, repeated rows included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            digests, n = np.unique(_cut(*flat_bytes(batch["__text"]))[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array(n.astype(np.int64))], ["digest", "n"])

    counted = df.select(utf8(text).alias("__text")).mapInArrow(run, "digest long, n long")
    return counted.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")


def repeated_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``doc_id``, ``row_digest``, ``starts``, ``ends`` (bytes) and ``n_repeated`` chunks of rows with removals.

    The texts are cut twice: first only to count digests, then to place the chunks that recur. So
    no place of the many chunks that occur once is stored.
    """
    spark = df.sparkSession
    recurring = materialize(recurring_digests(df, text), "recurring")
    release(spark)  # a finished step's shuffle does not lie beside the next one's
    every = materialize(chunks(df, doc_id, text).join(recurring, "digest"), "chunks")
    release(spark)
    place = F.struct("doc_id", "row_digest", "start")
    first = materialize(every.groupBy("digest").agg(F.min(place).alias("first")), "first")
    later = every.join(first, "digest").where(place != F.col("first"))
    # equal rows of one id have each chunk several times, at one and the same place
    rows = later.groupBy("doc_id", "row_digest").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("hits"))
    flat = rows.select("doc_id", "row_digest", F.col("hits.start").alias("starts"), F.col("hits.length").alias("lengths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, stops, hits = [], [], []
            for starts, lengths in zip(batch["starts"], batch["lengths"]):
                a = starts.values.to_numpy().astype(np.int64)
                b = a + lengths.values.to_numpy()
                apart = a[1:] != b[:-1]
                heads, tails = a[np.append(True, apart)], b[np.append(apart, True)]
                long = tails - heads >= min_run
                begins.append(heads[long])
                stops.append(tails[long])
                hits.append(len(a))
            sizes = np.array([len(x) for x in begins], np.int64)
            part = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (begins, stops)]
            found = pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["row_digest"], lists(part[0], sizes, pa.int32()), lists(part[1], sizes, pa.int32()),
                 pa.array(hits, pa.int32())], ["doc_id", "row_digest", "starts", "ends", "n_repeated"])
            yield found.filter(pa.array(sizes > 0))

    found = materialize(flat.mapInArrow(run, "doc_id long, row_digest long, starts array<int>, ends array<int>, n_repeated int"), "spans")
    discard(recurring, every, first)
    release(spark)
    return found


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """Every row of ``df`` with its text less the repeated spans, and the columns ``n_bytes``,
    ``n_removed`` and ``removed`` (spans ``start``, ``end`` in bytes). Null text stays null.
    """
    found = repeated_spans(df, doc_id, text, min_run).select(
        F.col("doc_id").alias("__id"), F.col("row_digest").alias("__digest"),
        F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    kept = [c for c in df.columns if c not in (text, "n_bytes", "n_removed", "removed")]
    # the text once: whether it was null goes with its bytes
    source = df.select(*kept, F.isnull(text).alias("__null"), utf8(text).alias("__text"), row_digest(text).alias("__row"))
    given = source.join(found, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__digest")), "left")
    given = given.select(*kept, "__null", "__text", "__starts", "__ends")
    out = T.StructType([
        *df.select(*kept, F.col(text).cast("string").alias(text)).schema.fields,
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(SPAN)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches, "__text"):
            texts, sizes, gone, spans = [], [], [], []
            for body, null, a, b in zip(batch["__text"].to_pylist(), batch["__null"].to_pylist(),
                                        batch["__starts"].to_pylist(), batch["__ends"].to_pylist()):
                cut = list(zip(a or [], b or []))
                edges = [0, *(x for pair in cut for x in pair), len(body)]
                left = b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2]))
                texts.append(None if null else left.decode("utf-8", "replace"))
                sizes.append(len(body))
                gone.append(len(body) - len(left))
                spans.append([{"start": x, "end": y} for x, y in cut])
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in kept), pa.array(texts, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(spans, span)], [f.name for f in out])

    return given.mapInArrow(run, out)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated passages in every whole text of ``documents``: what is removed, and a digest of what stays."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    found = deduplicate(documents.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").alias("n_spans"), "removed",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


QUERIES = {"op1_substring_dedup": (op1_substring_dedup, None)}
