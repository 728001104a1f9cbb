"""Exact removal of repeated byte strings, by suffix arrays built through Lyndon groups.

``suffix_array`` is the linear grouping construction: suffixes are grouped by the prefix that is
known of their longest Lyndon prefix; groups are processed in descending order, each finds the
previous smaller suffix of its members by following pointers, and what precedes a group is moved
into groups of its own; a second pass then emits every group in order. No recursion, no renaming.

One array of a whole corpus has no place in a cluster, so the text is cut where it can matter:

1. Among the ``ANCHOR``-byte strings of every ``LENGTH``-byte window the one with the least hash is
   the window's anchor. Equal windows have equal anchors. Successive windows with the same anchor
   are one stretch; it is known by its anchor and by a digest of all its bytes.
2. Stretches whose anchor occurs once repeat nothing. Stretches with equal bytes repeat wholly.
   What is left, once per distinct stretch, are stretches with an anchor in common but other bytes
   around it.
3. Window hashes, grouped before they are shuffled, tell which of those may share a window and
   with which stretch: the smallest stands for all that share it, so a hot passage gives each of
   its stretches one partner and not all. Hashes of what ``CELL`` neighbouring windows have in
   common tell before which windows are worth hashing.
4. A partner and up to ``MEMBERS`` of its stretches, as far as they may share anything, make one
   text. Its suffix array puts equal windows next to each other, where their bytes are compared.

Defined results: null text counts as empty and removes nothing; texts shorter than ``LENGTH`` bytes
remove nothing; repeated rows count as separate texts, so each makes the other's windows repeated;
rows are told apart by id and digest of the text and a null id is an id like any other; an empty
table gives an empty table. Other columns of the input are neither needed nor returned.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.blocks import Powers, flat_bytes, slices, spans, table_path, utf8
from strata.workspace import materialize

LENGTH = 200
ANCHOR = 64
MEMBERS = 128
CELL = 8  # windows that are first compared by what they all hold


def suffix_array(text) -> list[int]:
    """Starts of the suffixes of a sequence of non-negative numbers, in lexicographic order."""
    codes = np.append(np.asarray(text, np.int64) + 1, 0)
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
    sizes = np.diff(np.append(first, n))
    group, size, place = np.empty(n, np.int64), np.zeros(n, np.int64), np.empty(n, np.int64)
    group[order] = np.repeat(first, sizes)
    size[first] = sizes
    place[order] = np.arange(n)
    array, group, size, place = order.tolist(), group.tolist(), size.tolist(), place.tolist()
    before = [-1] * n  # previous smaller suffix
    end = n - 1
    while end > 0:
        start = group[array[end]]
        if start == end:
            p = array[end] - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[array[end]] = p
            end = start - 1
            if p >= 0:  # a group of one moves one suffix
                g = group[p]
                size[g] = left = size[g] - 1
                last = g + left
                other, at = array[last], place[p]
                array[at], place[other] = other, at
                array[last], place[p] = p, last
                group[p], size[last] = last, 1
            continue
        ahead = []
        for s in sorted(array[start : end + 1]):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[s] = p
            if p >= 0:
                ahead.append(p)
        end = start - 1
        if len(ahead) < 2 or len(set(ahead)) == len(ahead):
            batches = (ahead,)
        else:  # more members ahead of a smaller suffix: higher in its old group
            by_count: dict[int, list[int]] = {}
            for p, count in Counter(ahead).items():
                by_count.setdefault(count, []).append(p)
            batches = [by_count[c] for c in sorted(by_count, reverse=True)]
        for batch in batches:
            heads = {}
            for p in batch:
                g = group[p]
                size[g] = left = size[g] - 1
                heads[g] = last = g + left
                other, at = array[last], place[p]
                array[at], place[other] = other, at
                array[last], place[p] = p, last
            for p in batch:
                group[p] = heads[group[p]]
            if len(heads) == len(batch):
                for head in heads.values():
                    size[head] = 1
            else:
                for p in batch:
                    size[group[p]] = 0
                for p in batch:
                    size[group[p]] += 1
    out, head = [n - 1] * n, list(range(n))
    for i in range(n):
        s = out[i]
        j, stop = s - 1, before[s]
        while j > stop:
            g = group[j]
            out[head[g]] = j
            head[g] += 1
            j = before[j]
    return out[1:]


def repeated_windows(texts: list[np.ndarray], length: int = LENGTH) -> list[np.ndarray]:
    """For each text which of its windows of that length also start elsewhere in the texts."""
    # a separator of its own after each text, below all bytes, so that no window crosses one
    parts = [x for i, t in enumerate(texts) for x in (t.astype(np.int64) + len(texts), [i])]
    joined = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    whole = np.zeros(len(joined), bool)
    for a, t in zip(starts, texts):
        whole[a : a + max(len(t) - length + 1, 0)] = True
    array = np.array(suffix_array(joined), np.int64)
    array = array[whole[array]]
    found = np.zeros(len(joined), bool)
    for at in range(0, max(len(array) - 1, 0), 4096):
        a, b = array[at : at + 4096], array[at + 1 : at + 4097]
        a = a[: len(b)]
        equal = np.ones(len(a), bool)
        for k in range(0, length, 25):
            left = np.flatnonzero(equal)
            reach = np.arange(k, min(k + 25, length))
            equal[left] = (joined[a[left, None] + reach] == joined[b[left, None] + reach]).all(axis=1)
        found[a[equal]] = True
        found[b[equal]] = True
    return [found[a : a + max(len(t) - length + 1, 0)] for a, t in zip(starts, texts)]


def anchors(flat: np.ndarray, at: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, hash of the anchor, place of the anchor) of every stretch."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    width = LENGTH - ANCHOR + 1
    count = len(flat) - LENGTH + 1
    if count <= 0:
        return none
    hashes = powers.hashes(flat, np.arange(len(flat) - ANCHOR + 1), np.full(len(flat) - ANCHOR + 1, ANCHOR))
    window = np.arange(count)
    row = np.searchsorted(at, window, side="right") - 1
    valid = window + LENGTH <= at[row + 1]
    # hash and place in one number, in halves of which the low one wraps; ties go to the left
    bits = np.uint64(max(24, int(len(hashes)).bit_length()))
    value = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    window, place = window[valid], place[valid]
    if not len(window):
        return none
    new = np.append(True, (np.diff(place) != 0) | (np.diff(window) != 1))
    first = np.flatnonzero(new)
    return window[first], np.diff(np.append(first, len(window))), hashes[place[first]], place[first]


ROW = ("doc_id", "row_digest")


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(utf8(text)).alias("row_digest"), utf8(text).alias("body"))


def stretches(source: DataFrame) -> DataFrame:
    """``start``, number of ``windows``, place of the anchor (``lead``), ``anchor`` and ``stretch`` (digests) in every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches, "body"):
            flat, at = flat_bytes(batch["body"])
            first, count, key, place = anchors(flat, at, powers)
            row = np.searchsorted(at, first, side="right") - 1
            whole = powers.hashes(flat, first, count + LENGTH - 1)
            # the place of the anchor is part of the stretch: equal bytes mean equal windows
            whole = (whole ^ (key * np.uint64(0x9E3779B97F4A7C15))) + (place - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].take(pa.array(row)) for c in ROW), pa.array((first - at[row]).astype(np.int32)),
                 pa.array(count.astype(np.int16)), pa.array((place - first).astype(np.int16)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64))],
                [*ROW, "start", "windows", "lead", "anchor", "stretch"])

    return source.mapInArrow(run, "doc_id long, row_digest long, start int, windows short, lead short, anchor long, stretch long")


def _texts_of(wanted: DataFrame, source: DataFrame) -> DataFrame:
    """``stretch``, its ``lead`` and its ``bytes``, read from the row that stands for it."""
    asked = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("start", "windows", "lead", "stretch")).alias("asked"))
    asked = asked.select(F.col("doc_id").alias("id"), F.col("row_digest").alias("digest"), "asked")
    rows = source.join(asked, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_digest") == F.col("digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, asked in zip(batch["body"], batch["asked"]):
                body, asked = body.as_buffer(), asked.values
                starts = asked.field("start").to_numpy()
                ends = starts + asked.field("windows").to_numpy() + (LENGTH - 1)
                found = [body[int(a) : int(b)].to_pybytes() for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays([asked.field("stretch"), asked.field("lead"), pa.array(found, pa.binary())], ["stretch", "lead", "bytes"])

    flat = rows.select("body", "asked").mapInArrow(run, "stretch long, lead short, bytes binary")
    return flat.groupBy("stretch", "lead").agg(F.min("bytes").alias("bytes"))


def _strings(texts: DataFrame, length: int, step: int, mask: str | None = None) -> DataFrame:
    """``stretch``, ``cell``, ``at`` and ``string``: hashes of substrings of the texts.

    Windows are known by how far they begin before the anchor, and ``step`` neighbours make a cell.
    With ``step`` above 1 there is one string per cell, the ``length`` bytes that all its windows
    hold; else one per window, of the cells that ``mask`` names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches, "bytes"):
            flat, at = flat_bytes(batch["bytes"])
            windows = np.maximum(np.diff(at) - LENGTH + 1, 0)
            lead = batch["lead"].to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(windows)), windows)
            place = spans(np.zeros(len(windows), np.int64), windows)
            cell = (lead[owner] - place) // CELL
            if mask is None:
                new = np.append(True, (np.diff(cell) != 0) | (np.diff(owner) != 0))[: len(cell)]
                owner, cell = owner[new], cell[new]
                place = lead[owner] - cell * CELL
            else:
                wanted = batch[mask].to_numpy(zero_copy_only=False)
                keep = (wanted[owner] >> cell) & 1 == 1
                owner, cell, place = owner[keep], cell[keep], place[keep]
            found = powers.hashes(flat, at[owner] + place, np.full(len(place), length))
            found = found ^ (cell.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            yield pa.RecordBatch.from_arrays(
                [batch["stretch"].take(pa.array(owner)), pa.array(cell.astype(np.int8)), pa.array(place.astype(np.int16)),
                 pa.array(found.view(np.int64))], ["stretch", "cell", "at", "string"])

    return texts.mapInArrow(run, "stretch long, cell byte, at short, string long")


def _partners(texts: DataFrame) -> DataFrame:
    """``stretch``, ``partner`` and the windows ``first`` to ``last`` of the stretch that they may share.

    The partner is the smallest stretch with a window, also of itself. What all windows of a cell
    hold is compared first, so windows are hashed only where it recurs.
    """
    def shared(strings: DataFrame) -> DataFrame:
        ends = strings.groupBy("string").agg(F.min("stretch").alias("partner"), F.max("stretch").alias("most"))
        return strings.join(ends.where("partner <> most").select("string", "partner"), "string")

    cells = shared(_strings(texts, LENGTH - CELL + 1, CELL).drop("at"))
    cells = cells.groupBy("stretch").agg(F.bit_or(F.expr("shiftleft(1L, cell)")).alias("cells"))
    some = materialize(texts.join(cells, "stretch"), "recurring")
    return shared(_strings(some, LENGTH, 1, "cells").drop("cell")).groupBy("stretch", "partner").agg(
        F.min("at").cast("int").alias("first"), F.max("at").cast("int").alias("last"))


def _shared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``stretch`` and the windows ``first`` to ``last`` of it that also start elsewhere.

    ``pairs`` hold each partner once as its own. Only the bytes that a pair may share are read.
    """
    members, heads = pairs.where("stretch <> partner"), pairs.where("stretch = partner")
    parts = members.groupBy("partner").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("stretch"), F.col("parts")).cast("int")
    dealt = members.join(parts, "partner").select("partner", part.alias("part"), F.lit(1).alias("kind"), "stretch", "first", "last")
    heads = heads.join(parts, "partner").select(
        "partner", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "stretch", "first", "last")
    cut = F.substring("bytes", F.col("first") + 1, F.col("last") - F.col("first") + LENGTH)
    rows = dealt.unionByName(heads).join(texts, "stretch").select("partner", "part", "kind", "stretch", "first", cut.alias("bytes"))
    rows = rows.repartition("partner", "part").sortWithinPartitions("partner", "part", "kind", "stretch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[int, int]] = []
        texts: list[np.ndarray] = []
        found: list[tuple[int, int, int]] = []

        def solve() -> None:
            for (name, first), hit in zip(names, repeated_windows(texts)):
                edge = np.flatnonzero(np.diff(hit, prepend=False, append=False)).tolist()
                found.extend((name, first + a, first + b - 1) for a, b in zip(edge[::2], edge[1::2]))

        def emit() -> pa.RecordBatch:
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["stretch", "first", "last"])

        for batch in batches:
            for kind, name, first, body in zip(*(batch[c].to_pylist() for c in ("kind", "stretch", "first")), batch["bytes"]):
                # a head starts a new text; so does too large a share of one, which keeps its head
                if kind == 0:
                    if len(texts) > 1:
                        solve()
                    names[:], texts[:] = [], []
                elif len(texts) > 2 * MEMBERS:
                    solve()
                    names[:], texts[:] = names[:1], texts[:1]
                names.append((name, first))
                texts.append(np.frombuffer(body.as_buffer(), np.uint8).copy())
            yield emit()
        if len(texts) > 1:
            solve()
        yield emit()

    return rows.mapInArrow(run, "stretch long, first int, last int")


def repeated_bytes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``row_digest`` and ``pieces`` (start and end in bytes, may overlap) covered by repeats."""
    source = _keyed(df, doc_id, text)
    every = materialize(stretches(source), "stretches")
    keys = every.groupBy("anchor").agg(F.min("stretch").alias("x"), F.max("stretch").alias("y"), F.count("*").alias("n"))
    some = every.join(keys.where("n > 1"), "anchor").select(*ROW, "start", "windows", "lead", "stretch", (F.col("x") != F.col("y")).alias("mixed"))
    some = materialize(some, "candidates")
    kinds = materialize(
        some.groupBy("stretch").agg(F.count("*").alias("n"), F.max("mixed").alias("mixed"), F.min(F.struct(*ROW, "start", "windows", "lead")).alias("r"))
        .select("stretch", "n", "mixed", "r.*"), "kinds")
    texts = materialize(_texts_of(kinds.where("mixed"), source), "texts")
    # two stretches that occur several times each repeat wholly, whatever they share
    once = kinds.where("mixed AND n = 1").select(F.col("stretch").alias("alone"))
    pairs = materialize(_partners(texts), "pairs")
    alone = pairs.join(once, F.col("stretch") == F.col("alone"), "left_semi")
    served = pairs.join(once, F.col("stretch") == F.col("alone"), "left_anti").join(once, F.col("partner") == F.col("alone"), "left_semi")
    own = pairs.where("stretch = partner").join(once, F.col("stretch") == F.col("alone"), "left_anti")
    shared = _shared(materialize(alone.unionByName(served).unionByName(own), "wanted"), texts)
    whole = kinds.where("n > 1").select("stretch", F.lit(0).alias("first"), (F.col("windows") - 1).cast("int").alias("last"))
    ranges = materialize(shared.unionByName(whole), "ranges")
    pieces = some.join(ranges, "stretch").select(
        *ROW, F.struct((F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + LENGTH).alias("end")).alias("piece"))
    return pieces.groupBy(*ROW).agg(F.collect_set("piece").alias("pieces"))


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``removed`` (maximal runs) and ``kept`` (bytes) of every row."""
    found = repeated_bytes(df, doc_id, text).select(F.col("doc_id").alias("id"), F.col("row_digest").alias("digest"), "pieces")
    rows = _keyed(df, doc_id, text).join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_digest") == F.col("digest")), "left")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            sizes, gone, runs, kept = [], [], [], []
            for body, pieces in zip(batch["body"].to_pylist(), batch["pieces"]):
                mine: list[list[int]] = []
                values = pieces.values
                for a, b in sorted(zip(values.field("start").to_pylist(), values.field("end").to_pylist())) if values is not None else ():
                    if mine and a <= mine[-1][1]:
                        mine[-1][1] = max(mine[-1][1], b)
                    else:
                        mine.append([a, b])
                edges = [0, *(x for run in mine for x in run), len(body)]
                left = b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2]))
                sizes.append(len(body))
                gone.append(len(body) - len(left))
                runs.append([{"start": a, "end": b} for a, b in mine])
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())],
                [f.name for f in schema])

    return rows.select("doc_id", "body", "pieces").mapInArrow(run, schema)


def op9_suffix_array(spark, sf_dir: str) -> DataFrame:
    """Remove every byte of ``documents`` covered by a 200-byte string that also starts elsewhere."""
    found = remove_repeats(spark.read.parquet(table_path(sf_dir, "documents")))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op9_suffix_array": (op9_suffix_array, None)}
