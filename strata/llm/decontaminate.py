"""Benchmark decontamination by q-gram filtering and banded alignment.

A passage of n characters found with at most k edits shares at least ``n - q + 1 - k q`` character
q-grams with its place in the text, all on diagonals that differ by at most 2 k. So q-grams that
text and items share are counted in diagonal bands of width 4 k or more that overlap by half, the
bands that reach the bound are kept, and an alignment of the item within the band decides. Case of
A to Z and the kind and amount of white space don't count. k is ``EDITS`` of the item's length.

The index of the items is broadcast. Its size is checked: items beyond ``INDEX_BYTES`` of text are
dealt into several indexes by hash, and the documents go through one after the other; what a pass found is
stored with the documents before the next index is built, so driver and workers hold one index at a time.

Defined results: null and empty texts are clean; items that are null or shorter than q after
white space is joined match nothing; a null item id is left out; equal items are all reported; each
input row gives one output row, repeated or not; an empty table of documents gives an empty table, an
empty benchmark leaves every row clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.blocks import LOWER, WHITE, flat_bytes, slices, spans, table_path, utf8
from strata.workspace import materialize

Q = 8
EDITS = 0.1
INDEX_BYTES = 32 << 20
TABLE_BITS = 22
FACTOR = np.uint64(0x9E3779B97F4A7C15)

HIT = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType()),
])


class Index(NamedTuple):
    """The q-grams of some items."""

    ids: list[int]
    items: list[np.ndarray]
    budget: np.ndarray  # k of each item
    least: np.ndarray  # shared q-grams that an occurrence must have
    grams: np.ndarray  # sorted distinct q-grams
    begin: np.ndarray  # their ranges in the two arrays below
    item: np.ndarray
    offset: np.ndarray


def normal(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case with runs of white space as one blank: (bytes, place of each in the input)."""
    white = WHITE[flat]
    keep = np.ones(len(flat), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    plain = LOWER[flat]
    plain[white] = 32
    return plain[keep], np.flatnonzero(keep)


def grams(flat: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as numbers; the last places, which have fewer, are left out."""
    padded = np.concatenate([flat, np.zeros(Q, np.uint8)])
    found = np.empty(len(flat), np.uint64)
    for i in range(Q):
        part = padded[i:]
        part = part[: len(part) // Q * Q].view(np.uint64)
        count = len(found[i::Q])
        found[i::Q] = part[:count]
    return found[: max(len(flat) - Q + 1, 0)]


def build_index(rows: list[tuple[int, bytes]], edits: float = EDITS) -> Index:
    """The index of (id, text) items."""
    ids, items = [], []
    for number, text in sorted(rows):
        plain = normal(np.frombuffer(text, np.uint8))[0].tobytes().strip(b" ")
        if len(plain) >= Q:
            ids.append(number)
            items.append(np.frombuffer(plain, np.uint8))
    sizes = np.array([len(i) for i in items], np.int64)
    budget = np.minimum((sizes * edits).astype(np.int64), np.maximum(sizes - Q, 0) // Q)
    every = [grams(i) for i in items]
    item = np.repeat(np.arange(len(items)), [len(g) for g in every]) if items else np.zeros(0, np.int64)
    offset = np.concatenate([np.arange(len(g)) for g in every]) if items else np.zeros(0, np.int64)
    flat = np.concatenate(every) if items else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    found, begin = np.unique(flat[order], return_index=True)
    return Index(ids, items, budget, sizes - Q + 1 - budget * Q, found, np.append(begin, len(flat)), item[order], offset[order])


def align(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the item's best place in the region, if it takes at most ``most`` edits.

    One row of the dynamic program per character of the item; a row is the whole band.
    """
    exact = region.tobytes().find(item.tobytes())
    if exact >= 0:
        return 0, exact, exact + len(item)
    width = len(region)
    column = np.arange(width + 1)
    # the cost and where the alignment began, in one number, so that one minimum carries both
    scale = width + 1
    row = column.copy()
    for char in item:
        step = row[:-1] + np.where(region == char, 0, scale)
        best = np.empty(width + 1, np.int64)
        best[0] = row[0] + scale
        best[1:] = np.minimum(step, row[1:] + scale)
        row = np.minimum.accumulate(best - column * scale) + column * scale
        if row.min() // scale > most:
            return None
    end = int(row.argmin())
    edits, start = divmod(int(row[end]), scale)
    return (edits, start, end) if edits <= most else None


class Searcher:
    """An index with its lookup table. Lives in one worker."""

    def __init__(self, index: Index):
        self.index = index
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self._slot(index.grams)] = True
        self.band = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(4 * index.budget, 1))).astype(np.int64))

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * FACTOR) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, flat: np.ndarray, at: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """(item id, start, end, edits) of the items found in each text, by item, best place of each."""
        x = self.index
        found: list[dict] = [{} for _ in range(len(at) - 1)]
        plain, source = normal(flat)
        borders = np.searchsorted(source, at)  # a border between two blanks joins none: see below
        codes = grams(plain)
        place = np.flatnonzero(self.table[self._slot(codes)]) if len(x.grams) else np.zeros(0, np.int64)
        number = np.searchsorted(x.grams, codes[place])
        hit = number < len(x.grams)
        hit[hit] = x.grams[number[hit]] == codes[place[hit]]
        place, number = place[hit], number[hit]
        row = np.searchsorted(borders, place, side="right") - 1
        inside = place + Q <= borders[row + 1]
        place, number, row = place[inside], number[inside], row[inside]
        counts = x.begin[number + 1] - x.begin[number]
        which = spans(x.begin[number], counts)
        item, diagonal = x.item[which], np.repeat(place, counts) - x.offset[which]
        row = np.repeat(row, counts)
        candidates = set()
        for half in (0, 1):
            width = self.band[item]
            band = (diagonal - borders[row] + (1 << 24) + half * width // 2) // width
            key = (row << np.int64(44)) | (item << np.int64(28)) | band
            values, n = np.unique(key, return_counts=True)
            for k in values[n >= x.least[(values >> 28) & 0xFFFF]].tolist():
                r, i, b = k >> 44, (k >> 28) & 0xFFFF, k & ((1 << 28) - 1)
                w = int(self.band[i])
                candidates.add((r, i, b * w - half * w // 2 - (1 << 24), w))
        for r, i, low, w in sorted(candidates):
            a, b = int(borders[r]), int(borders[r + 1])
            k = int(x.budget[i])
            begin = max(a, a + low - k)
            region = plain[begin : min(b, a + low + w + len(x.items[i]) + k)]
            if len(region) and (best := align(x.items[i], region, k)):
                edits, start, end = best
                span = (edits, int(source[begin + start] - at[r]), int(source[begin + end - 1] + 1 - at[r]))
                found[r][i] = min(found[r].get(i, span), span)
        return [[(x.ids[i], s, e, edits) for i, (edits, s, e) in sorted(f.items())] for f in found]


ITEMS_PER_INDEX = 1 << 16


def _parts(benchmark: DataFrame, item_id: str, text: str, index_bytes: int) -> list[DataFrame]:
    """The items as one or more parts, each within the size bound."""
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
    size, rows = items.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    parts = max(1, -(-2 * size // index_bytes) if size > index_bytes else 1, -(-2 * rows // ITEMS_PER_INDEX) if rows > ITEMS_PER_INDEX else 1)
    part = F.pmod(F.xxhash64(item_id, text), F.lit(parts))
    wanted = items.select(F.col(item_id).cast("long"), utf8(text))
    return [wanted.where(part == i).distinct() for i in range(parts)]


def find_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    edits: float = EDITS, index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """Every row of ``df`` and ``leaks``: item, place in bytes and edits of each benchmark passage in its text."""
    names = [c for c in df.columns if c != "leaks"]
    result = df.select(*names).withColumn("leaks", F.array().cast(T.ArrayType(HIT)))
    schema = result.schema
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value)
            for batch in slices(batches, "__text"):
                found = searcher.search(*flat_bytes(batch["__text"]))
                leaks = [
                    old + [dict(zip(("item_id", "start", "end", "edits"), h)) for h in new]
                    for old, new in zip(batch["leaks"].to_pylist(), found)
                ]
                yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(leaks, kind)], [*names, "leaks"])
        return run

    parts = _parts(benchmark, item_id, item_text, index_bytes)
    for at, part in enumerate(parts):
        shared = df.sparkSession.sparkContext.broadcast(build_index([tuple(r) for r in part.collect()], edits))
        result = result.withColumn("__text", utf8(text)).mapInArrow(search(shared), schema)
        if at + 1 < len(parts):  # so that driver and workers hold one index at a time
            result = materialize(result, "leaks")
            shared.destroy()
    return result


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark passages in every whole text of ``documents``."""
    documents = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    found = find_leaks(documents, spark.read.parquet(table_path(sf_dir, "benchmark")))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("leaks.item_id")).alias("item_ids"), "leaks",
    )


QUERIES = {"op8_decontaminate": (op8_decontaminate, None)}
