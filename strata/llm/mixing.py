"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is a sequence of bytes and one end; Huffman codes learned from the training bytes, one for
each byte before, turn it into binary decisions, about three a byte. Each of several contexts (the last bytes, the word so
far) has a hashed table that predicts a decision from the counts of the training texts. A mixer
adds the predictions' log odds with weights; the weight set is chosen by which long contexts were
seen, and the weights are refined by the error after every ``STEP`` decisions, from a fixed start
at the begin of the text to its end. Only what comes before a decision predicts it, so the
product of the decisions is a probability of the text.

Counting covers every training text. Each task adds up its own tables and sends them in segments,
summed in two rounds; the result has ``2 ** bits`` cells a context at any input size, which is
what is broadcast (``TABLE_BITS``: 11 MB). For the base score a token is one row for each slice of
texts, so a frequent one has no more rows than there are slices, and its join can be split.

Defined results: null text counts as empty and has one token, the end; a null id counts as the
empty string in hashes; each input row gives one output row, repeated rows equal ones; without
training rows every count is 0; an empty table gives an empty table. Other columns are not needed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.blocks import LOWER, WHITE, Powers, flat_bytes, slices, table_path, utf8, words
from strata.llm.shipping import release
from strata.workspace import discard, materialize

END = 256
PAD = 257  # before the first byte
SYMBOLS = 258
BEFORE = 6  # bytes that the longest context looks back
ORDERS = (3, 5)
TABLE_BITS = (21, 22, 22)  # of each order, then of the word so far
SEGMENT = 1 << 16
STEP = 64
LANES = 512
RATE = 0.01
FIRST = 0.3  # what both outcomes count before any is seen
SCALE = 16.0  # table cells are log odds times this, in one byte
# start weights by (word so far seen, longest order seen), for the orders and the word
START = np.array([[1.0, 0.0, 0.0], [0.4, 0.6, 0.0], [0.4, 0.0, 0.6], [0.2, 0.3, 0.6]], np.float32)
TOKEN_SLICE = 4 << 20
# texts counted and scored at a time: what they need should stay in a cache
COUNT_BYTES = 1 << 17
SCORE_BYTES = 1 << 18
COUNT_MOST = 1 << 31  # decisions that a task counts before it sends what it has

_RANDOM = np.random.default_rng(2)
ORDER_FACTORS = _RANDOM.integers(1, 1 << 62, BEFORE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NODE_OFFSETS = _RANDOM.integers(0, 1 << 40, SYMBOLS * SYMBOLS).astype(np.int64)


class Code(NamedTuple):
    """Binary codes of the symbols 0 to END, one for each symbol before: steps of each, one after the other."""

    begin: np.ndarray  # by symbol before and symbol
    length: np.ndarray
    offset: np.ndarray  # of the tree node in the tables
    bit: np.ndarray


def huffman(counts: list[int]) -> list[list[tuple[int, int]]]:
    """(tree node, bit) of each step to each symbol; every symbol counts once more, so each has a code."""
    heap: list[tuple] = [(c + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    inner: list[tuple[int, int]] = []
    size = len(counts)
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a + b, size + len(inner)))
        inner.append((x, y))
    paths: list[list[tuple[int, int]]] = [[] for _ in range(size + len(inner))]
    for node in range(len(inner) - 1, -1, -1):
        for bit, child in enumerate(inner[node]):
            paths[child] = [*paths[size + node], (node, bit)]
    return paths[:size]


def build_code(pairs: np.ndarray) -> Code:
    """The codes for counts of (symbol before, symbol)."""
    length = np.zeros((SYMBOLS, SYMBOLS), np.int64)
    nodes, bits = [], []
    for before in range(SYMBOLS):
        for symbol, path in enumerate(huffman(pairs[before, : END + 1].tolist())):
            length[before, symbol] = len(path)
            nodes += [before * SYMBOLS + n for n, _ in path]
            bits += [b for _, b in path]
    flat = length.ravel()
    return Code(np.cumsum(flat) - flat, flat, NODE_OFFSETS[nodes], np.array(bits, np.int64))


def _symbols(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of the texts, each with padding before it and its end behind it; places to predict)."""
    rows, size = len(at) - 1, np.diff(at)
    first = at[:-1] + np.arange(rows) * (BEFORE + 1) + BEFORE
    symbols = np.full(len(flat) + rows * (BEFORE + 1), PAD, np.int64)
    body = np.ones(len(symbols), bool)
    for i in range(1, BEFORE + 1):
        body[first - i] = False
    body[first + size] = False
    symbols[body] = flat
    symbols[first + size] = END
    return symbols, np.flatnonzero(symbols != PAD)


class Decisions(NamedTuple):
    """The binary decisions of some texts."""

    contexts: list[np.ndarray]  # hash of every symbol's context, by table
    lengths: np.ndarray  # decisions of every symbol
    offset: np.ndarray  # what the tree node of a decision adds to the hash
    bits: np.ndarray
    counts: np.ndarray  # decisions of each text

    def places(self, table: int, size: int) -> np.ndarray:
        """The place of every decision in a table of so many cells, a power of two."""
        found = np.repeat(self.contexts[table], self.lengths)
        found += self.offset
        found &= size - 1
        return found


def decisions(flat: np.ndarray, at: np.ndarray, code: Code, powers: Powers) -> Decisions:
    """All decisions of the texts, with the hash of each context."""
    symbols, place = _symbols(flat, at)
    mixed = symbols.astype(np.uint64)
    mixed += np.uint64(1)
    contexts, rolled = [], np.zeros(len(mixed), np.uint64)
    for back in range(1, max(ORDERS) + 1):
        rolled[back:] += mixed[:-back] * ORDER_FACTORS[back - 1]
        if back in ORDERS:
            contexts.append(rolled[place])
    # the word so far: from behind the last white space, in lower case
    folded = np.where(symbols < 256, LOWER[np.minimum(symbols, 255)], 32).astype(np.uint8)
    behind = np.maximum.accumulate(np.where(WHITE[folded], np.arange(len(symbols)), 0))
    begin = behind[place - 1] + 1
    contexts.append(powers.hashes(folded, begin, place - begin))
    contexts = [((c ^ (c >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)).astype(np.int64) for c in contexts]
    pair = symbols[place - 1] * SYMBOLS + symbols[place]
    lengths = code.length[pair]
    ends = np.cumsum(lengths)
    step = np.repeat(code.begin[pair] - (ends - lengths), lengths)
    step += np.arange(len(step))
    last = np.cumsum(np.diff(at) + 1)
    counts = np.diff(np.concatenate([[0], ends[last - 1]])) if len(last) else np.zeros(0, np.int64)
    return Decisions(contexts, lengths, code.offset.take(step), code.bit.take(step), counts)


class Model(NamedTuple):
    code: Code
    tables: list[np.ndarray]  # int8 log odds of each context


def _segments(counts: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Count tables in segments: one byte a count, and the places and values of larger ones."""
    number = 0
    for table in counts:
        for at in range(0, len(table), 2 * SEGMENT):
            part = table[at : at + 2 * SEGMENT]
            large = np.flatnonzero(part > 254)
            if part.any():
                yield number, np.minimum(part, 255).astype(np.uint8).tobytes(), large.astype(np.uint32).tobytes(), part[large].astype(np.int64).tobytes()
            number += 1


SEGMENT_SCHEMA = "segment int, salt long, small binary, places binary, large binary"


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["segment", "salt", "small", "places", "large"])


def _sum_segments(df: DataFrame, salt: Column) -> DataFrame:
    """The sum of all parts of each segment and salt, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None

        def emit():
            large = np.flatnonzero(total > 254)
            small = np.minimum(total, 255).astype(np.uint8)
            return _segment_batch([(*held, small.tobytes(), large.astype(np.uint32).tobytes(), total[large].tobytes())])

        for batch in batches:
            for segment, number, small, places, large in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
                if held != (segment, number):
                    if held:
                        yield emit()
                    held, total = (segment, number), np.zeros(2 * SEGMENT, np.int64)
                part = np.frombuffer(small, np.uint8).astype(np.int64)
                part[np.frombuffer(places, np.uint32)] = np.frombuffer(large, np.int64)
                total += part
        if held:
            yield emit()

    dealt = df.withColumn("salt", salt).repartition("segment", "salt").sortWithinPartitions("segment", "salt")
    return dealt.mapInArrow(run, SEGMENT_SCHEMA)


def fit(training: DataFrame) -> Model:
    """Learn code and tables from all rows of ``training``, whose one column ``body`` holds bytes."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in slices(batches, "body"):
            symbols, place = _symbols(*flat_bytes(batch["body"]))
            total += np.bincount(symbols[place - 1] * SYMBOLS + symbols[place], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["pair", "n"])

    # at most one row for each pair of symbols
    counted = training.mapInArrow(histogram, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    pairs[[r["pair"] for r in counted]] = [r["n"] for r in counted]
    code = build_code(pairs.reshape(SYMBOLS, SYMBOLS))
    shared = training.sparkSession.sparkContext.broadcast(code)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, code, part = Powers(), shared.value, TaskContext.get().partitionId()
        counts = [np.zeros(2 << bits, np.uint32) for bits in TABLE_BITS]
        made = 0
        for batch in slices(batches, "body", COUNT_BYTES):
            found = decisions(*flat_bytes(batch["body"]), code, powers)
            if made + len(found.bits) > COUNT_MOST:
                yield from (_segment_batch([(segment[0], part, *segment[1:])]) for segment in _segments(counts))
                counts, made = [np.zeros_like(table) for table in counts], 0
            made += len(found.bits)
            for i, table in enumerate(counts):
                place = found.places(i, len(table) // 2)
                place *= 2
                place += found.bits
                np.add.at(table, place, np.uint32(1))
        yield from (_segment_batch([(segment[0], part, *segment[1:])]) for segment in _segments(counts))

    partial = training.mapInArrow(count, SEGMENT_SCHEMA)
    summed = _sum_segments(_sum_segments(partial, F.floor(F.col("salt") / 64)), F.lit(0).cast("long"))

    def odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for small, places, large in zip(*(batch[c].to_pylist() for c in ("small", "places", "large"))):
                total = np.frombuffer(small, np.uint8).astype(np.float64)
                total[np.frombuffer(places, np.uint32)] = np.frombuffer(large, np.int64)
                ratio = np.log((total[1::2] + FIRST) / (total[0::2] + FIRST)) * SCALE
                out.append(np.clip(np.rint(ratio), -127, 127).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([batch["segment"], pa.array(out, pa.binary())], ["segment", "odds"])

    tables = [np.zeros(1 << bits, np.int8) for bits in TABLE_BITS]
    where = [(t, at) for t, bits in enumerate(TABLE_BITS) for at in range(0, 1 << bits, SEGMENT)]
    # a fixed number of segments of a fixed size, whatever the input
    for segment, body in map(tuple, summed.mapInArrow(odds, "segment int, odds binary").collect()):
        table, at = where[segment]
        tables[table][at : at + SEGMENT] = np.frombuffer(body, np.int8)
    return Model(code, tables)


def mix(found: Decisions, tables: list[np.ndarray]) -> np.ndarray:
    """The natural log probability of each text."""
    cells = [table.take(found.places(i, len(table))) for i, table in enumerate(tables)]
    gates = (cells[-2] != 0).view(np.int8) + 2 * (cells[-1] != 0).view(np.int8)
    signs = (2 * found.bits - 1).astype(np.int8)
    # the longest text first, so that lanes of a group end together
    length = found.counts
    begin = np.cumsum(length) - length
    order = np.argsort(-length, kind="stable")
    result = np.zeros(len(found.counts))
    sets, column = len(START), np.arange(STEP)
    for at in range(0, len(order), LANES):
        lanes = order[at : at + LANES]
        left, first, base = length[lanes], begin[lanes, None], np.arange(len(lanes))[:, None] * sets
        # cells are log odds times SCALE, so weights are divided by it, and their changes twice
        weights = [np.tile(START[:, k] / np.float32(SCALE), len(lanes)) for k in range(len(cells))]
        sums, ends = np.zeros(len(lanes)), -(-left // STEP)
        for t in range(int(ends[0])):
            live = int(np.searchsorted(-ends, -t, side="left"))
            place = first[:live] + (t * STEP + column)
            over = None
            if left[live - 1] < (t + 1) * STEP:  # decisions behind the end of a text count nothing
                over = t * STEP + column >= left[:live, None]
                np.minimum(place, len(signs) - 1, out=place)
            own = gates.take(place) + base[:live]
            mark = signs.take(place).astype(np.float32)
            inputs = [c.take(place).astype(np.float32) for c in cells]
            score = inputs[0] * weights[0].take(own)
            for x, w in zip(inputs[1:], weights[1:]):
                score += x * w.take(own)
            miss = np.exp(np.clip(score, -12, 12, out=score) * -mark)
            hit = 1 / (1 + miss)
            chance = np.log(hit)
            push = miss * hit * mark * np.float32(RATE / SCALE**2)
            if over is not None:
                chance[over] = push[over] = 0
            sums[:live] += chance.sum(axis=1, dtype=np.float64)
            own = own.ravel()
            for x, w in zip(inputs, weights):
                x *= push
                w[: live * sets] += np.bincount(own, x.ravel(), live * sets).astype(np.float32)
        result[lanes] = sums
    return result


def score_texts(df: DataFrame, model: Model, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``score`` (log10 probability) and ``bits_per_byte`` of every ``body``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(*keep).schema.add("score", "double").add("bits_per_byte", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, powers = shared.value, Powers()
        for batch in slices(batches, "body", SCORE_BYTES):
            flat, at = flat_bytes(batch["body"])
            score = mix(decisions(flat, at, model.code, powers), model.tables)
            density = -score / np.log(2) / np.maximum(np.diff(at), 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), pa.array(score / np.log(10)), pa.array(density)], [f.name for f in schema])

    return df.mapInArrow(run, schema)


PACKED = "slice long, ids binary, digests binary, nulls binary, sizes binary, tokens binary, trained binary, holding binary, holder binary, times binary"


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in the narrowest width that holds them all."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _widen(packed: bytes, size: int) -> np.ndarray:
    """The ``size`` numbers that ``_narrow`` packed."""
    return np.frombuffer(packed, f"u{len(packed) // size}") if size else np.zeros(0, np.uint8)


def _hashed_words(batch: pa.RecordBatch, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word of ``body`` in lower case. Bytes are widened for a block of rows at a time."""
    hashes, holders, before = [], [], 0
    for part in slices(iter([batch]), "body"):
        flat, at = flat_bytes(part["body"])
        flat = LOWER[flat]
        starts, lengths, row = words(flat, at)
        hashes.append(powers.hashes(flat, starts, lengths))
        holders.append(row + before)
        before += part.num_rows
    return np.concatenate(hashes), np.concatenate(holders)


def _deal_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice of texts: its rows, its distinct tokens by hash, and which row holds which how often."""
    powers, part = Powers(), TaskContext.get().partitionId()
    for number, batch in enumerate(slices(batches, "body", TOKEN_SLICE)):
        found, row = _hashed_words(batch, powers)
        rows = batch.num_rows
        found = np.concatenate([found, np.zeros(rows, np.uint64)])  # 0: the end
        row = np.concatenate([row, np.arange(rows)])
        token, inverse = np.unique(found, return_inverse=True)
        pair, times = np.unique(inverse * np.int64(rows) + row, return_counts=True)
        holder, index = pair % rows, pair // rows
        train = batch["training"].to_numpy(zero_copy_only=False)
        trained = np.bincount(index, times * train[holder], len(token))
        ids, digests = (np.asarray(batch[c].cast(pa.int64()).fill_null(0)).astype(np.int64) for c in ("doc_id", "row_digest"))
        nulls = np.asarray(batch["doc_id"].is_null()).astype(np.uint8)
        held = (np.bincount(row, minlength=rows), trained, np.bincount(index, minlength=len(token)), holder, times)
        size, trained, *held = map(_narrow, held)
        packed = (ids.tobytes(), digests.tobytes(), nulls.tobytes(), size, token.tobytes(), trained, *held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + number]), *(pa.array([p], pa.binary()) for p in packed)],
            [field.split()[0] for field in PACKED.split(", ")])


def _spread_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice and distinct token of it."""
    for batch in batches:
        for name, tokens, trained in zip(*(batch[c].to_pylist() for c in ("slice", "tokens", "trained"))):
            tokens = np.frombuffer(tokens, np.int64)
            columns = (np.full(len(tokens), name), np.arange(len(tokens), dtype=np.int32), tokens, _widen(trained, len(tokens)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slice", "place", "token", "n"])


def base_scores(df: DataFrame) -> DataFrame:
    """``n_tokens``, ``n_known``, ``train_tokens`` and ``base_score`` of each (doc_id, row_digest).

    ``df`` has these two, ``training`` (boolean) and ``body``. Rows go in slices of bounded size, which
    are stored. A token is one row a slice, however many of its texts hold it; Spark sums those rows
    and joins the counts back to the slices, and a slice adds up what its own tokens count.
    """
    packed = materialize(df.select("doc_id", "row_digest", "training", "body").mapInArrow(_deal_tokens, PACKED), "token-slices")
    spread = packed.select("slice", "tokens", "trained").mapInArrow(_spread_tokens, "slice long, place int, token long, n long")
    counts = materialize(spread.where("n > 0").groupBy("token").agg(F.sum("n").alias("count")), "token-counts")
    size, tokens = counts.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    scale = float(np.log10(tokens + 0.5 * (size + 1)))
    known = spread.select("slice", "place", "token").join(counts, "token").drop("token")

    def finish(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        own = own.iloc[0]
        ids, digests, nulls = (np.frombuffer(own[c], kind) for c, kind in (("ids", np.int64), ("digests", np.int64), ("nulls", np.uint8)))
        count = np.zeros(len(own["tokens"]) // 8, np.int64)
        count[known["place"].to_numpy()] = known["count"].to_numpy()
        sizes, holding = _widen(own["sizes"], len(ids)).astype(np.int64), _widen(own["holding"], len(count))
        index = np.repeat(np.arange(len(count)), holding)
        holder, times = (_widen(own[c], len(index)) for c in ("holder", "times"))
        # tokens in the order of their hashes, so a text's sum does not depend on its slice
        sums = np.bincount(holder, times * np.log10(count + 0.5)[index], len(ids))
        seen = np.bincount(holder, times * (count > 0)[index], len(ids)).astype(np.int64)
        return pd.DataFrame({
            "doc_id": pd.array(np.where(nulls == 1, None, ids) if nulls.any() else ids, "Int64"),
            "row_digest": digests, "n_tokens": sizes, "n_known": seen, "train_tokens": tokens, "base_score": sums - sizes * scale})

    rows = packed.drop("trained").groupBy("slice").cogroup(known.groupBy("slice")).applyInPandas(
        finish, "doc_id long, row_digest long, n_tokens long, n_known long, train_tokens long, base_score double")
    found = materialize(rows.dropDuplicates(["doc_id", "row_digest"]), "base-scores")
    discard(packed, counts)
    release(df.sparkSession)
    return found


def score_documents(df: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Model and base score of every whole text, learned from the rows that are not held out."""
    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(utf8(text)).alias("row_digest"),
        held_out.alias("held_out"), utf8(text).alias("body"))
    base = base_scores(rows.withColumn("training", ~F.col("held_out")))
    model = fit(rows.where(~F.col("held_out")).select("body"))
    release(df.sparkSession)
    scored = score_texts(rows, model, ("doc_id", "row_digest", "held_out"))
    base = base.withColumnsRenamed({"doc_id": "id", "row_digest": "digest"})
    joined = scored.join(base, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_digest") == F.col("digest")))
    return joined.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op2_lm_score(spark, sf_dir: str) -> DataFrame:
    """Score every whole text of ``documents``; rows whose id's crc32 is 1 modulo 5 are held out."""
    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    return score_documents(documents, crc == 1)


QUERIES = {"op2_lm_score": (op2_lm_score, None)}
