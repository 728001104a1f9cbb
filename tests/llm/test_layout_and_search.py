"""Sharding, the Merkle manifest and ranked search against their SQL and brute force."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import DOCS
from oracle import assert_same, connect
from strata.llm import merkle, ranking, shards
from strata.llm.blocks import table_path
from strata.llm.catalog import QUERIES

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row_number string, root string, position int, c0 string, gid string, terms string"


@pytest.mark.parametrize("name", ["op11_sharding", "op12_merkle", "op13_ranked_search"])
def test_sql(spark, name):
    build, sql = QUERIES[name]
    assert_same(build(spark, DOCS), connect(DOCS), sql)


@pytest.fixture(scope="module")
def clashing(spark, odd_rows):
    rows = [(i, t, lang, (None, "a", "é", "")[at % 4], at, "r", "s", 1, "c", "g", "t") for at, (i, t, lang) in enumerate(odd_rows)]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 10, 37, 64, 100, 1000, 4097])
def test_permutations(spark, n):
    for seed in (1, 77):
        chosen = shards.Permutation(n, seed)
        assert 0 <= chosen.cells - n <= max(chosen.sides)
        places = [chosen.place(i, 3) for i in range(n)]
        assert sorted(slot * 3 + shard for shard, slot in places) == list(range(n))
        assert [chosen.row(*place, 3) for place in places] == list(range(n))
        cells = spark.range(n).select("id", chosen.cell(F.col("id"), chosen.longest_walk(spark)).alias("cell"))
        assert {r["id"]: (r["cell"] % 3, r["cell"] // 3) for r in cells.collect()} == dict(enumerate(places))


def test_a_large_permutation():
    chosen = shards.Permutation((1 << 60) - 3)
    for row in (0, 1, 12345678901234567, (1 << 60) - 4):
        assert chosen.row(*chosen.place(row)) == row


def test_shards_of_odd_rows(clashing, none, tmp_path, spark):
    found = shards.shard_rows(clashing, ["doc_id", "text"], 4)
    rows = found.collect()
    assert len(rows) == clashing.count()
    assert sorted(r["row_number"] for r in rows) == list(range(len(rows)))
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 4, len(rows) // 4 + 1)
    again = shards.shard_rows(clashing.repartition(7, "lang"), ["doc_id", "text"], 4).collect()
    place = ("doc_id", "text", "row_number", "shard", "slot")
    assert Counter(tuple(r[c] for c in place) for r in rows) == Counter(tuple(r[c] for c in place) for r in again)
    assert rows[0]["root"] == "s" and shards.shard_rows(none, ["doc_id"]).collect() == []
    # the result can be filtered on what the network gives
    assert found.where("shard = 1 AND slot >= 1").count() == sum(r["shard"] == 1 and r["slot"] >= 1 for r in rows)
    shards.write_shards(clashing, str(tmp_path / "shards"), ["doc_id", "text"], 4, rows_per_file=2)
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r["row_number"], r["shard"], r["slot"]) for r in written.collect()} == {(r["row_number"], r["shard"], r["slot"]) for r in rows}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        first = at // 16 * 16
        found += [d for i, d in enumerate(level[first : first + 16]) if first + i != at]
        at //= 16
    return found


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 4096])
def test_appended_trees(n):
    leaves = [digest(str(i)) for i in range(n)]
    tree = merkle.Appender()
    for leaf in leaves:
        tree.append(leaf)
    levels = levels_of(leaves)
    assert tree.finish(merkle.height(n)) == levels[-1][0]
    for at in {0, n // 2, n - 1}:
        assert "".join(step["beside"] for step in tree.witness(at)) == "".join(siblings(levels, at))


def test_witnesses_grow_with_later_siblings():
    tree = merkle.Appender()
    for i in range(16):
        assert tree.leaves == [] or tree.witness(0) == []
        tree.append(digest(str(i)))
    assert len(tree.witness(3)) == 1
    for i in range(16, 256):
        tree.append(digest(str(i)))
    assert len(tree.witness(3)) == len(tree.witness(255)) == 2


@pytest.mark.parametrize("n", [1, 4097, 9000])
def test_block_roots_are_appended_further(spark, n):
    """More than one block in a group, beside groups of one row."""
    rows = [("big", i, digest(str(i))) for i in range(n)] + [(None, 7, digest("null")), ("z", None, digest("z"))]
    found = merkle.build(spark.createDataFrame(rows, "source string, doc_id long, leaf string").repartition(5), "source", ["doc_id"])
    checked = found.select("source", "position", "subroot", "root", "leaf", merkle.proof(F.col("witness")).alias("proof"),
                           merkle.fold(F.col("leaf"), F.col("witness")).alias("folded")).collect()
    big = levels_of([digest(str(i)) for i in range(n)])
    top = levels_of([digest("null"), big[-1][0], digest("z")])
    assert len(checked) == n + 2
    for row in checked:
        assert row["root"] == row["folded"] == top[-1][0]
        if row["source"] == "big" and row["position"] % 97 == 0 or row["source"] != "big":
            levels = big if row["source"] == "big" else [[row["leaf"]]]
            group = {None: 0, "big": 1, "z": 2}[row["source"]]
            assert row["proof"] == digest(*siblings(levels, row["position"]), *siblings(top, group))
            assert row["subroot"] == levels[-1][0]


def test_manifest_of_odd_rows(clashing, none):
    leaves = clashing.withColumn("leaf", merkle.leaf([F.col(c) for c in merkle.FIELDS]))
    rows = merkle.build(leaves, "source", ["doc_id"]).collect()
    assert len(rows) == clashing.count() and len({r["root"] for r in rows}) == 1
    by_source = {}
    for row in sorted(rows, key=lambda r: r["position"]):
        fields = [row[c] for c in merkle.FIELDS]
        want = digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))
        assert row["leaf"] == want and row["c0"] == "c" and row["gid"] == "g"
        by_source.setdefault(row["source"], []).append(want)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    assert rows[0]["root"] == levels_of([levels_of(by_source[s])[-1][0] for s in order])[-1][0]
    assert merkle.build(none.withColumn("leaf", F.lit("x")), "source", ["doc_id"]).collect() == []


def test_tampering_is_found(spark):
    documents = {r["doc_id"]: r["text"] for r in spark.read.parquet(table_path(DOCS, "documents")).collect()}
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    rows = QUERIES["op12_merkle"][0](spark, DOCS).collect()
    for row in rows:
        text = documents[row["doc_id"]] or ""
        changed = zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text.translate(lower) != text
        assert row["verified"] == (not changed)
    assert any(not r["verified"] for r in rows) and any(r["verified"] for r in rows)


def brute_ranks(documents, items, top):
    """(item_id, rank, doc_id, score) by scoring every document."""
    def terms(text):
        return ranking.terms_of((text or "").encode())

    known = [(i, Counter(terms(t))) for i, t in documents if terms(t)]
    n, length = len(known), sum(sum(c.values()) for _, c in known)
    holding = Counter(t for _, c in known for t in c)
    found = []
    for item_id, text in {(i, t) for i, t in items if t is not None}:
        scored = []
        for i, counts in known:
            m = 100 - 90 + 90 * sum(counts.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in set(terms(text)) if counts[t])
            scored.append((-score, i is None, i or 0, i))
        found += [(item_id, at + 1, s[3], -s[0]) for at, s in enumerate(sorted(scored)[:top]) if s[0]]
    return Counter(found)


ITEMS = [(1, "term1 term2 TERM79"), (1, "term1 term2 TERM79"), (2, "one two"), (2, "three"), (3, None), (4, ""), (5, "?? !"), (None, "début passage3 日本語"),
         (6, " ".join(f"word{i}x{i}" for i in range(0, 400))), (7, "absent words only")]


@pytest.mark.parametrize("chunk_bytes", [ranking.CHUNK_BYTES, 64])
def test_ranks_of_odd_rows(spark, clashing, odd_rows, chunk_bytes):
    """Also with more than 64 terms an item, and with items in several chunks."""
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, rank string")
    found = ranking.rank(clashing, items, chunk_bytes=chunk_bytes).collect()
    want = brute_ranks([(i, t) for i, t, _ in odd_rows], ITEMS, ranking.TOP)
    assert Counter(map(tuple, found)) == want


def test_ranks_without_rows(spark, clashing, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking.rank(none, items).collect() == [] and ranking.rank(clashing, items.limit(0)).collect() == []
    assert ranking.rank(clashing, items.where("item_id = 7")).collect() == []


def test_few_documents_are_scored(spark):
    """Groups whose bound is below the tenth best are left alone, and the result stays that of scoring all."""
    rows = [(i, " ".join(["common", "often" if i % 3 else "seldom", f"rare{i % 50}", *(["rarest"] if i % 90 == 0 else [])])) for i in range(2000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = [(1, "common often rarest rare10"), (2, "seldom rare7")]
    got = ranking.rank(documents, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute_ranks(rows, items, ranking.TOP)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, text in items for t in ranking.terms_of(text.encode())}))}
    batch = ranking.postings(documents, vocabulary, "doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    block = ranking.Block(batch, 2000, 4000)
    terms = [vocabulary[t] for t in ranking.terms_of(items[0][1].encode())]
    weights = ranking.np.array([1 if t == vocabulary[b"common"] else 4000 for t in sorted(terms)])
    scored = ranking.search_block(block, ranking.np.searchsorted(block.terms, sorted(terms)), weights, ranking.Best(10))
    assert 10 <= scored < 1500
