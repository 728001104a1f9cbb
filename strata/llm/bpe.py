"""Byte-pair encoding and decoding by speculation and verification.

A greedy longest match over a trie of the vocabulary proposes tokens for all distinct words of a
block at once. A sequence of tokens is the byte-pair encoding of its bytes if and only if each
token encodes to itself and each adjacent pair could stand side by side when merging ends, so
every adjacent pair is checked, again all at once, by undoing merges on both sides of the border.
Words with a failing pair, and only those, are merged exactly.

Defined results: null text counts as empty and has no ids; the special strings of the file are
tokens wherever they occur in a text, as the tokenizers library has it; each input row gives one
output row, so repeated rows, ties and null ids stay as they are; an empty table gives an empty
table. Other columns of the input are neither needed nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.blocks import Powers, flat_bytes, lists, slices, spans, table_path, utf8

# Before merging, text is split into words as by the pattern
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# The endings after an apostrophe that are words of their own.
SHORT_ENDINGS = np.array([ord(c) for c in "stmd"], np.uint32)
LONG_ENDINGS = np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")], np.int64)
OTHER, LETTER, NUMBER, SPACE = range(4)

NEVER = np.int64(1) << 40
SHORT_WORD = 256
CACHED_WORDS = 200_000
ENCODED_BYTES = 1 << 19
MERGED_CELLS = 1 << 17  # words times letters that are merged at once


class Vocabulary(NamedTuple):
    """What encoding and decoding need; its size is that of the vocabulary file, never of the data."""

    words: list[bytes]  # bytes of each id
    left: np.ndarray  # the two ids a token was merged from, -1 for single bytes
    right: np.ndarray
    rank: np.ndarray  # order of that merge, -1 for single bytes
    pair_keys: np.ndarray  # sorted left * size + right of every merge
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    byte_ids: np.ndarray
    special: dict[str, int]


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, symbols = content["model"], _byte_symbols()
    special = {t["content"]: t["id"] for t in content.get("added_tokens") or []}
    size = max([*model["vocab"].values(), *special.values()]) + 1
    words = [b""] * size
    for token, number in model["vocab"].items():
        words[number] = bytes(symbols[c] for c in token)
    for token, number in special.items():
        words[number] = token.encode()
    left, right, rank = (np.full(size, -1, np.int64) for _ in range(3))
    keys, ids = [], []
    for order, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        a_id, b_id, ab = (model["vocab"][x] for x in (a, b, a + b))
        if rank[ab] < 0:
            left[ab], right[ab], rank[ab] = a_id, b_id, order
        keys.append(a_id * size + b_id)
        ids.append(ab)
    by_key = np.argsort(np.array(keys, np.int64), kind="stable")
    byte_ids = np.zeros(256, np.int64)
    for symbol, byte in symbols.items():
        byte_ids[byte] = model["vocab"][symbol]
    return Vocabulary(
        words, left, right, rank, np.array(keys, np.int64)[by_key], by_key.astype(np.int64),
        np.array(ids, np.int64)[by_key], byte_ids, special,
    )


class Encoder:
    """A vocabulary with its trie, and the words seen so far. Lives in one task, so that idle workers hold none."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.size = len(vocabulary.words)
        self.kinds = _char_kinds()
        self.special = {s.encode(): i for s, i in vocabulary.special.items()}
        self.powers = Powers()
        self.merges = {
            (int(k) // self.size, int(k) % self.size): (int(r), int(i))
            for k, r, i in zip(vocabulary.pair_keys, vocabulary.pair_ranks, vocabulary.pair_ids)
        }
        self._build_trie()
        self.forget()

    def forget(self) -> None:
        """Drop the words seen so far."""
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.counts, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def _build_trie(self) -> None:
        merged = [i for i in range(self.size) if self.v.rank[i] >= 0 and self.merge(self.v.words[i]) == [i]]
        children: list[dict[int, int]] = [{}]
        accept = [-1]
        for number in [*map(int, self.v.byte_ids), *merged]:
            node = 0
            for byte in self.v.words[number]:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    accept.append(-1)
                node = children[node][byte]
            accept[node] = number
        inner = [i for i, c in enumerate(children) if c]
        self.accept = np.array(accept, np.int32)
        self.row = np.zeros(len(children), np.int32)
        self.row[inner] = np.arange(1, len(inner) + 1)
        self.next = np.zeros((len(inner) + 1, 256), np.int32)  # row 0: no child; node 0 is never a child
        for i in inner:
            for byte, child in children[i].items():
                self.next[self.row[i], byte] = child
        self.next = self.next.reshape(-1)

    def merge(self, word: bytes) -> list[int]:
        """Exact merging of one word, which may be long: lowest rank first, leftmost among equals."""
        ids = [int(self.v.byte_ids[b]) for b in word]
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (found := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, a, b, number = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = number, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of the merge of a and b or NEVER, its id); a negative b is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.v.pair_keys, key), len(self.v.pair_keys) - 1)
        found = (self.v.pair_keys[at] == key) & (b >= 0)
        return np.where(found, self.v.pair_ranks[at], NEVER), self.v.pair_ids[at]

    def merge_all(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words of similar, small length: (ids one after the other, ids per word).

        All words take their next merge together, each its own: a row per word, a column per symbol.
        """
        width = int(lengths.max())
        column = np.arange(width)
        inside = column < lengths[:, None]
        symbols = np.full((len(starts), width + 1), -1, np.int64)
        symbols[:, :-1][inside] = self.v.byte_ids[flat[spans(starts, lengths)]]
        ranks, ids = self._pairs(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        ranks, ids = ranks.reshape(-1, width), ids.reshape(-1, width)
        final = np.full((len(starts), width), -1, np.int64)
        rows = np.arange(len(starts))
        while rows.size:
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            done = ranks[each, at] >= NEVER
            if done.any():
                final[rows[done]] = symbols[done, :-1]
                rows, symbols, ranks, ids, at = (x[~done] for x in (rows, symbols, ranks, ids, at))
                each = np.arange(len(rows))
                if not rows.size:
                    break
            symbols[each, at] = ids[each, at]
            after = column > at[:, None]
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ids[:, :-1] = np.where(after[:, :-1], ids[:, 1:], ids[:, :-1])
            ranks[:, -1] = NEVER
            ranks[each, at], ids[each, at] = self._pairs(symbols[each, at], symbols[each, at + 1])
            inner = np.flatnonzero(at > 0)
            left = at[inner] - 1
            ranks[inner, left], ids[inner, left] = self._pairs(symbols[inner, left], symbols[inner, left + 1])
        return final[final >= 0], (final >= 0).sum(axis=1)

    def propose(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words: (word of each token, token), words in order."""
        place, active = starts.copy(), np.flatnonzero(ends > starts)
        owners, tokens = [], []
        while active.size:
            p, end = place[active], ends[active]
            best, length = np.zeros(active.size, np.int64), np.zeros(active.size, np.int64)
            live, node, depth = np.arange(active.size), np.zeros(active.size, np.int64), 0
            while live.size:
                node = self.next[self.row[node].astype(np.int64) * 256 + flat[p[live] + depth]]
                alive = node > 0
                live, node = live[alive], node[alive]
                depth += 1
                token = self.accept[node]
                hit = token >= 0
                best[live[hit]], length[live[hit]] = token[hit], depth
                more = p[live] + depth < end[live]
                live, node = live[more], node[more]
            owners.append(active)
            tokens.append(best)
            place[active] += length
            active = active[place[active] < ends[active]]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b can stay side by side: no merge across the border comes too early."""
        v, ok = self.v, np.ones(len(a), bool)
        live, limit = np.arange(len(a)), np.full(len(a), NEVER)
        while live.size:
            cross, _ = self._pairs(a, b)
            bad = cross < limit
            ok[live[bad]] = False
            of_a, of_b = v.rank[a], v.rank[b]
            keep = ~bad & ((of_a >= 0) | (of_b >= 0))
            live, a, b, of_a, of_b = live[keep], a[keep], b[keep], of_a[keep], of_b[keep]
            # undo the later merge; of equal merges the right one came later
            undo_a = of_a > of_b
            limit = np.where(undo_a, of_a, of_b + 1)
            a, b = np.where(undo_a, v.right[a], a), np.where(undo_a, b, v.left[b])
        return ok

    def learn(self, flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> None:
        """Encode words that were not seen before; they are numbered from the last one known."""
        ends = begins + lengths
        owner, token = self.propose(flat, begins, np.where(lengths <= SHORT_WORD, ends, begins))
        same = np.flatnonzero(owner[1:] == owner[:-1])
        failing = np.zeros(len(begins), bool)
        failing[owner[same[~self.compatible(token[same], token[same + 1])]]] = True
        failing |= lengths > SHORT_WORD
        counts = np.bincount(owner, minlength=len(begins))
        token = token[~failing[owner]]
        counts[failing] = 0
        starts = np.cumsum(counts) - counts
        found = [token]
        total = len(token)

        def put(words: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
            nonlocal total
            starts[words], counts[words] = total + np.cumsum(sizes) - sizes, sizes
            found.append(ids)
            total += len(ids)

        least = 0
        for most in (6, 8, 12, 16, 24, 40, 64):
            words = np.flatnonzero(failing & (lengths > least) & (lengths <= most))
            for part in range(0, len(words), MERGED_CELLS // most):
                some = words[part : part + MERGED_CELLS // most]
                put(some, *self.merge_all(flat, begins[some], lengths[some]))
            least = most
        for word in np.flatnonzero(failing & (lengths > least)):
            ids = self.merge(flat[begins[word] : ends[word]].tobytes())
            put(np.array([word]), np.array(ids, np.int64), np.array([len(ids)]))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, *found])

    def _segments(self, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts cut at special strings: (start of each piece, its special id or -1, its text)."""
        body = flat.tobytes()
        if not any(s in body for s in self.special):
            return at[:-1], np.full(len(at) - 1, -1), np.arange(len(at) - 1)
        found = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        starts, specials, owners = [], [], []
        for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            place = a
            for match in found.finditer(body, a, b):
                starts += [place, match.start()]
                specials += [-1, self.special[match.group()]]
                owners += [row, row]
                place = match.end()
            starts.append(place)
            specials.append(-1)
            owners.append(row)
        return np.array(starts), np.array(specials), np.array(owners)

    def split(self, flat: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """First byte of every word. A word never crosses one of the borders (byte positions)."""
        first = np.flatnonzero((flat & 0xC0) != 0x80)
        chars = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(chars)
        kind = self.kinds[chars]
        cut = np.zeros(n + 1, bool)
        cut[np.searchsorted(first, borders)] = True
        cut[n] = True
        run = cut[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        word = run & (kind != SPACE)
        starts = run.copy()
        blank = kind == SPACE
        # of white space before a word, the last character stands alone or, a blank, joins the word
        last = np.flatnonzero(word[1:] & blank[:-1] & ~cut[1:-1])
        starts[last] = True
        joined = last[chars[last] == 32]
        starts[joined + 1] = False
        # 's and the like: an apostrophe that begins a word, and the letters after it
        mark = np.flatnonzero((chars == 39) & starts)
        mark = mark[mark + 1 < n]
        mark = mark[~cut[mark + 1]]
        one = mark[np.isin(chars[mark + 1], SHORT_ENDINGS)]
        mark = mark[mark + 2 < n]
        mark = mark[~cut[mark + 2]]
        two = mark[np.isin(chars[mark + 1].astype(np.int64) << 32 | chars[mark + 2], LONG_ENDINGS)]
        for at, size in ((one, 2), (two, 3)):
            starts[at + 1] = False
            rest = at + size
            rest = rest[rest < n]
            starts[rest[(kind[rest] == LETTER) & ~cut[rest]]] = True
        return first[np.flatnonzero(starts)]

    def encode(self, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text), from UTF-8 and offsets."""
        if len(self.hashes) > CACHED_WORDS:
            self.forget()
        if not len(flat):
            return np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
        pieces, specials, owners = self._segments(flat, at)
        inside = pieces < len(flat)
        begins = self.split(flat, pieces[inside])
        if (specials >= 0).any():  # the bytes of a special string are one word
            lies = np.searchsorted(pieces, begins, side="right") - 1
            begins = begins[(specials[lies] < 0) | (begins == pieces[lies])]
        lengths = np.diff(np.append(begins, len(flat)))
        hashes = self.powers.hashes(flat, begins, lengths)
        for i in np.flatnonzero(lengths > SHORT_WORD):
            hashes[i] = xxhash.xxh3_64_intdigest(flat[begins[i] : begins[i] + lengths[i]].tobytes())
        unique, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        if len(self.hashes):
            known = self.hashes[np.minimum(place, len(self.hashes) - 1)] == unique
        if not known.all():
            new = where[~known]
            self.places = np.insert(self.places, place[~known], len(self.starts) + np.arange(len(new)))
            self.hashes = np.insert(self.hashes, place[~known], unique[~known])
            self.learn(flat, begins[new], lengths[new])
        number = self.places[np.searchsorted(self.hashes, unique)][back]
        starts, counts, ids = self.starts[number], self.counts[number], self.ids
        if (specials >= 0).any():
            lies = np.searchsorted(pieces, begins, side="right") - 1
            special = specials[lies] >= 0
            starts = np.where(special, len(ids) + specials[lies], starts)
            counts = np.where(special, 1, counts)
            ids = np.concatenate([ids, np.arange(self.size)])
        ends = np.concatenate([[0], np.cumsum(counts)])
        rows = ends[np.searchsorted(begins, at)]
        return ids[spans(starts, counts)], np.diff(rows)


def _char_kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    import regex

    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0
    every = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for match in regex.finditer(pattern, every):
            kinds[match.start() : match.end()] = kind
    return kinds


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids``, the encoding of the whole text. One row per input row.

    The vocabulary is read by the driver and broadcast; its size is fixed by the file.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    source = df.select(*keep, utf8(text).alias("__text"))
    kept = df.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches, "__text", ENCODED_BYTES):
            ids, counts = encoder.encode(*flat_bytes(batch.column("__text")))
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, lists(ids, counts, pa.int32())], [*keep, "ids"])

    return source.mapInArrow(run, kept.add("ids", T.ArrayType(T.IntegerType())))


class Pieces:
    """The bytes that each id stands for, laid end to end, so that many ids are joined at once."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The joined pieces of each run of ids."""
        body = self.flat[spans(self.starts[ids], self.lengths[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        rows = ends[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [body[a:b] for a, b in zip(rows[:-1], rows[1:])]


def decode(df: DataFrame, vocabulary_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``, decoded from the ids; bytes that are no UTF-8 become U+FFFD.

    Null ids give an empty text.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path).words)
    kept = df.select(*keep).schema
    source = df.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                column = part["__ids"]
                values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pieces.join(values, np.diff(np.asarray(column.offsets)))
                texts = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*(part[name] for name in keep), texts], [*keep, "text"])

    return source.mapInArrow(run, kept.add("text", "string"))


def round_trip(df: DataFrame, vocabulary_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the number of ids, and SHA-256 of the ids (decimal, joined by commas) and of the decoded text.

    Encodes and decodes in one pass, so the ids need not leave the worker.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    source = df.select(*keep, utf8(text).alias("__text"))
    schema = df.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        words = Pieces(shared.value.words)
        decimals = Pieces([b"%d," % i for i in range(encoder.size)])
        for batch in slices(batches, "__text", ENCODED_BYTES):
            ids, counts = encoder.encode(*flat_bytes(batch["__text"]))
            listed = [hashlib.sha256(t[:-1]).hexdigest() for t in decimals.join(ids, counts)]
            decoded = [t.decode("utf-8", "replace").encode() for t in words.join(ids, counts)]
            decoded = [hashlib.sha256(t).hexdigest() for t in decoded]
            yield pa.RecordBatch.from_arrays(
                [*(batch[name] for name in keep), pa.array(counts), pa.array(listed), pa.array(decoded)],
                [f.name for f in schema],
            )

    return source.mapInArrow(run, schema)


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``."""
    import public_tokenizers

    documents = spark.read.parquet(table_path(sf_dir, "documents"))
    return round_trip(documents, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op5_bpe": (op5_bpe, None)}
