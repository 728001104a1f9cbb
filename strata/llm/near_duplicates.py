"""Near-duplicate documents: an inverted join on the coordinates of MinHash signatures.

1. Every text becomes its set of distinct five-word shingles, a digest of that set and a signature
   of ``COORDINATES`` minima. Equal sets form one class, represented by its smallest id.
2. A representative is posted under its (coordinate, value) pairs. Two sets of the wanted
   similarity agree in at least ``AGREE`` coordinates but for a chance of about one in a million
   (``AGREE`` is five standard deviations below the mean), so they share one of the
   ``COORDINATES - AGREE + 1`` pairs that come first in order of rarity: only this prefix is posted.
   Pairs that nobody else has come first of all, so a text with enough of them is skipped.
3. In each posting list one member is the centre, and all are compared with it: collisions of the
   signatures first, which are narrow; the full sets are sent only for those that pass. A large group
   of copies thus needs comparisons in proportion to its members, most of which have one name
   afterwards, the centre's.
4. Lists that still hold several names are joined exactly: lists with the same smallest member are
   one group, cut into chunks of bounded size; each pair of chunks finds, by an inverted index over
   shingles, links between members of different names. Only a forest of the links leaves a group.

Documents are linked when ``100 * intersection >= PERCENT * union`` on the full sets.

Defined results: null or empty text, or text without words, has an empty set, is linked with
nothing and stays; with fewer than five words all words are one shingle; rows with a null id have
no component, count as kept and link with nothing; repeated rows of an id are one document with
equal results, or, where their texts differ, are all linked under that id; an empty table gives an
empty table. Other columns of the input are neither needed nor returned.

A text is sent to where its set is wanted only if a Bloom filter of the wanted ids holds its id; the
filter has ``BLOOM_BITS`` at any input size and lets more through as it fills, and the join decides.

The result is stored. Each step's shuffle files are released before the next one writes its own, and
stored steps are deleted once all that reads them is stored, so a caller's own shuffles find no
signatures and sets beside them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.blocks import LOWER, Powers, flat_bytes, slices, table_path, utf8, words
from strata.llm.components import components
from strata.llm.shipping import release
from strata.workspace import discard, materialize

SHINGLE = 5
PERCENT = 75
COORDINATES = 64
AGREE = 31
PREFIX = COORDINATES - AGREE + 1
CHUNK_SHINGLES = 1 << 20
STAR_MEMBERS = 64  # members of a posting list that are compared with its centre in one place
BLOOM_BITS = 1 << 24  # 2 MB
BLOOM_HASHES = 2

_RANDOM = np.random.default_rng(6)
WORD_FACTORS = _RANDOM.integers(1, 1 << 62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MINIMA_FACTORS = _RANDOM.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(flat: np.ndarray, at: np.ndarray, powers: Powers) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat = LOWER[flat]
    starts, lengths, row = words(flat, at)
    hashes = powers.hashes(flat, starts, lengths)
    first = np.searchsorted(row, np.arange(len(at)))
    rolled = np.zeros(max(len(hashes) - SHINGLE + 1, 0), np.uint64)
    for i in range(SHINGLE):
        rolled += hashes[i : i + len(rolled)] * WORD_FACTORS[i]
    rolled ^= rolled >> np.uint64(31)
    rolled *= np.uint64(0x94D049BB133111EB)
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            few = (hashes[a:b] * WORD_FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(np.array([few], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum of each set under each hash function, 32 bits each; sets must not be empty."""
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    found = np.zeros((len(sets), COORDINATES), np.uint32)
    if len(flat):
        flat = flat ^ (flat >> np.uint64(32))
        for i, factor in enumerate(MINIMA_FACTORS):
            found[:, i] = np.minimum.reduceat(((flat * factor) >> np.uint64(32)).astype(np.uint32), starts)
    return found


def _binary(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary())


def sketch(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set and ``signature`` (null for empty sets) of each row."""
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches, "__text"):
            sets = shingle_sets(*flat_bytes(batch["__text"]), powers)
            full = [i for i, s in enumerate(sets) if len(s)]
            digest: list[bytes | None] = [None] * len(sets)
            signature: list[bytes | None] = [None] * len(sets)
            for i, minima in zip(full, signatures([sets[i] for i in full])):
                digest[i], signature[i] = xxhash.xxh3_128_digest(sets[i].tobytes()), minima.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), _binary(digest), _binary(signature)],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    return source.mapInArrow(run, "doc_id long, n_shingles long, digest binary, signature binary")


def postings(classes: DataFrame) -> DataFrame:
    """``rep`` and ``key``: the posted prefix of each class, with keys that others have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinate = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
        for batch in batches:
            if batch.num_rows:
                flat, _ = flat_bytes(batch["signature"])
                keys = flat.view(np.uint32).reshape(-1, COORDINATES) | coordinate
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch["rep"].to_numpy(zero_copy_only=False), COORDINATES)),
                     pa.array(keys.astype(np.int64).ravel())], ["rep", "key"],
                )

    every = classes.select("rep", "signature").mapInArrow(run, "rep long, key long")
    shared = every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    common = every.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
    # the missing pairs are unique and so come first; what they leave of the prefix is posted
    posted = F.slice("keys", F.lit(1), F.greatest(F.lit(0), F.lit(PREFIX - COORDINATES) + F.size("keys")))
    return common.select("rep", F.explode(posted).alias("p")).select("rep", "p.key")


def _jaccard(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted distinct arrays are similar enough."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _agree(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two signatures collide often enough."""
    return (a.view(np.uint32) == b.view(np.uint32)).sum() >= AGREE


def _verify_stars(pairs: DataFrame, contents: DataFrame, alike: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The (centre, rep) pairs whose contents are ``alike``, as ``a`` and ``b``; ``contents`` has ``rep`` and ``content``.

    A centre's content is sent once for about ``STAR_MEMBERS`` of its members, before theirs.
    """
    many = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR_MEMBERS).alias("salts"))
    salted = pairs.join(many, "centre").select("centre", F.pmod(F.xxhash64("rep"), F.col("salts")).alias("salt"), "rep")
    members = salted.select("centre", "salt", "rep", F.col("rep").alias("of"))
    centres = salted.select("centre", "salt").distinct().select(
        "centre", "salt", F.lit(None).cast("long").alias("rep"), F.col("centre").alias("of"))
    # one join for both, so that contents are sent to it once
    rows = members.unionByName(centres).join(contents.withColumnRenamed("rep", "of"), "of").select("centre", "salt", "rep", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, []  # an id with several texts has several contents
        for batch in batches:
            out = []
            for centre, rep, content in zip(batch["centre"].to_pylist(), batch["rep"].to_pylist(), batch["content"]):
                content = np.frombuffer(content.as_buffer(), np.uint8)
                if rep is None:
                    own = [*(own if held == centre else []), content.copy()]
                    held = centre
                elif any(alike(c, content) for c in own):
                    out.append((centre, rep))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    dealt = rows.repartition("centre", "salt").sortWithinPartitions("centre", "salt", F.asc_nulls_first("rep"))
    return dealt.mapInArrow(run, "a long, b long")


def link_members(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A forest of the links between members of different components, in one pair of chunks."""
    group = group.reset_index(drop=True)
    n = len(group)
    names, parent = group["component"].to_numpy().tolist(), {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    if len(set(names)) < 2:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
    sizes = np.array([len(s) for s in sets])
    _, owner_of = np.unique(np.concatenate(sets), return_inverse=True)
    by_shingle = np.argsort(owner_of, kind="stable")
    owners = np.repeat(np.arange(n), sizes)[by_shingle]
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner_of))])
    place = np.concatenate([[0], np.cumsum(sizes)])
    reps, links = group["rep"].to_numpy(), []
    largest = group["component"].mode()[0]
    for i in range(n):
        if names[i] == largest:  # its links within are known, the others find it
            continue
        mine = owner_of[place[i] : place[i + 1]]
        both = np.bincount(np.concatenate([owners[begin[k] : begin[k + 1]] for k in mine]), minlength=n)
        for j in np.flatnonzero(100 * both >= percent * (sizes + sizes[i] - both)):
            x, y = find(names[i]), find(names[j])
            if x != y:
                parent[x] = y
                links.append((reps[i], reps[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _link_rest(posted: DataFrame, sets: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Links between members of a posting list that the stars did not put together already.

    ``stars`` give each member the smallest centre it is linked with, and that centre its own: those
    with the same name are linked. Lists with one name are done. The others go by their smallest
    member, so lists of the same group of copies are one group of work. ``posted`` and ``sets`` are
    deleted once the members are stored with their sets.
    """
    near = stars.groupBy(F.col("b").alias("rep")).agg(F.min("a").alias("centre"))
    near = near.withColumn("centre", F.least("centre", "rep"))
    above = near.select(F.col("rep").alias("centre"), F.col("centre").alias("over"))
    names = materialize(near.join(above, "centre", "left").select("rep", F.coalesce("over", "centre").alias("component")), "names")
    named = posted.join(names, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = named.groupBy("key").agg(F.min("rep").alias("head"), F.min("component").alias("x"), F.max("component").alias("y"))
    rest = materialize(named.join(mixed.where("x <> y").select("key", "head"), "key").select("head", "rep", "component").distinct(), "mixed")
    members = materialize(rest.join(sets, "rep"), "members")
    chunks = members.groupBy("head").agg(F.ceil(F.sum(F.length("shingles") / 8) / CHUNK_SHINGLES).cast("int").alias("chunks"))
    dealt = (
        members.join(chunks, "head")
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("head", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "rep", "component", "shingles")
    )
    discard(posted, sets)
    release(posted.sparkSession)
    found = materialize(dealt.groupBy("head", "x", "y").applyInPandas(lambda g: link_members(g, percent), "a long, b long"), "rest")
    discard(names, rest, members)
    return found


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    spark = df.sparkSession
    signed = materialize(sketch(df, doc_id, text), "signed")
    classes = materialize(
        signed.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "signature")).alias("r"))
        .select("digest", F.col("r.doc_id").alias("rep"), "r.signature"), "classes")
    sketches = materialize(signed.drop("signature"), "sketches")
    discard(signed)
    named = sketches.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    release(spark)
    posted = materialize(postings(classes), "postings")
    release(spark)
    wanted = materialize(posted.select("rep").distinct().join(classes, "rep"), "wanted")
    release(spark)
    centre = posted.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep")).alias("centre"), F.count("*").alias("n")).where("n > 1")
    pairs = posted.join(centre, "key").where("rep <> centre").select("centre", "rep").distinct()
    alike = materialize(_verify_stars(pairs, wanted.select("rep", F.col("signature").alias("content")), _agree), "alike")
    release(spark)
    sets = _sets(df, doc_id, text, wanted.select("rep", "digest"))
    stars = materialize(_verify_stars(
        alike.toDF("centre", "rep").distinct(), sets.withColumnRenamed("shingles", "content"),
        lambda a, b: _jaccard(a.view(np.uint64), b.view(np.uint64), percent)), "links")
    discard(wanted, alike)
    release(spark)
    rest = _link_rest(posted, sets, stars, percent)
    release(spark)
    # an id with several texts links its classes
    several = named.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("doc_id")
    several = named.join(several, "doc_id").join(classes.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(stars.unionByName(rest).unionByName(several)).withColumnRenamed("node", "rep")
    # an id that is in several classes is a node itself; any other document has its class's component
    own = classes.select("digest", "rep").join(found, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    result = materialize(
        sketches.join(own, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near-duplicates")
    discard(sketches, classes, stars, rest, found)
    release(spark)
    return result


def _bits(hashed: str) -> list[Column]:
    """The places of an id in the Bloom filter."""
    return [F.pmod(F.xxhash64(hashed, F.lit(i)), F.lit(BLOOM_BITS)).cast("int") for i in range(BLOOM_HASHES)]


def _bloom(ids: DataFrame) -> np.ndarray:
    """The filter's bytes: at most one row for each 64 of its bits reaches the driver."""
    places = ids.select(F.explode(F.array(*_bits(ids.columns[0]))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63))
    found = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(BLOOM_BITS // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint8)


def _perhaps_wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rep`` and ``__text`` of the rows whose id is wanted, and of few others."""
    shared = texts.sparkSession.sparkContext.broadcast(_bloom(wanted.select("rep")))
    names = [f"__p{i}" for i in range(BLOOM_HASHES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            places = [batch[n].to_numpy() for n in names]
            hit = np.logical_and.reduce([held[p >> 3] >> (p & 7) & 1 for p in places])
            yield batch.select(["rep", "__text"]).filter(pa.array(hit))

    placed = texts.where("rep IS NOT NULL").select("rep", "__text", *(p.alias(n) for n, p in zip(names, _bits("rep"))))
    return placed.mapInArrow(run, "rep long, __text binary")


def _sets(df: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """``rep`` and ``shingles`` (sorted hashes) of the wanted classes, stored.

    The sets are stored before repeated rows are dropped, so the shuffled texts and the shuffled sets
    do not lie on disk together.
    """
    texts = df.select(F.col(doc_id).cast("long").alias("rep"), utf8(text).alias("__text"))
    source = _perhaps_wanted(texts, wanted).join(wanted, "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches, "__text"):
            sets = shingle_sets(*flat_bytes(batch["__text"]), powers)
            wanted = batch["digest"].to_pylist()
            keep = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [batch["rep"].take(pa.array(keep, pa.int64())), batch["digest"].take(pa.array(keep, pa.int64())),
                 _binary([sets[i].tobytes() for i in keep])], ["rep", "digest", "shingles"],
            )

    every = materialize(source.mapInArrow(run, "rep long, digest binary, shingles binary"), "every-set")
    release(df.sparkSession)
    found = materialize(every.groupBy("rep", "digest").agg(F.min("shingles").alias("shingles")).drop("digest"), "sets")
    discard(every)
    release(df.sparkSession)
    return found


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components over every whole text of ``documents``."""
    return near_duplicates(spark.read.parquet(table_path(sf_dir, "documents")))


QUERIES = {"op6_minhash": (op6_minhash, None)}
