"""Near duplicates, repeated chunks and repeated byte strings against brute force."""

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from brute import DOCS, brute_components, sets_of
from strata.llm import chunks, suffixes
from strata.llm.blocks import table_path
from strata.llm.components import components
from strata.llm.near_duplicates import near_duplicates


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()))
    assert found == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def check(rows, documents):
    sets = sets_of(documents)
    want = brute_components(sets)
    for row in rows:
        if row["doc_id"] is not None:
            assert row["component_id"] == want[row["doc_id"]], row
            assert row["n_shingles"] == len(sets[row["doc_id"]])
            assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    check(rows, [(i, t) for i, t, _ in odd_rows if i is not None])
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2


def test_near_duplicates_of_many_copies(spark):
    """A large group of near copies whose links are many, and a chain that no centre sees whole."""
    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for place in random.choice(120, int(random.integers(0, 6)), replace=False):
            words[place] = f"x{random.integers(1 << 30)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):
        rows.append((500 + i, " ".join(chain[i * 8 : i * 8 + 90])))
    check(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect(), rows)


def test_near_duplicates_of_documents(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents"))
    check(near_duplicates(documents).collect(), [tuple(r) for r in documents.select("doc_id", "text").collect()])


def test_near_duplicates_of_no_rows(none):
    assert near_duplicates(none).collect() == []


def test_chunks_survive_insertions():
    random = np.random.default_rng(2)
    text = bytes(random.integers(97, 123, 5000, dtype=np.uint8))
    moved = b"inserted " + text[:2000] + b"more" + text[2000:]
    cut = []
    for body in (text, moved):
        flat = np.frombuffer(body, np.uint8)
        starts = chunks.chunk_starts(flat, np.array([0, len(flat)]))
        edges = [*starts.tolist(), len(flat)]
        assert b"".join(body[a:b] for a, b in zip(edges, edges[1:])) == body
        assert max(b - a for a, b in zip(edges, edges[1:])) <= chunks.MOST
        cut.append({body[a:b] for a, b in zip(edges, edges[1:])})
    assert len(cut[0] & cut[1]) > 0.9 * len(cut[0])


def test_chunks_depend_on_their_text_alone():
    """Each text is cut alone as it is behind any others, empty ones included."""
    random = np.random.default_rng(7)
    texts = [bytes(random.integers(97, 100, int(random.integers(0, 400)), dtype=np.uint8)) for _ in range(1500)]
    at = np.cumsum([0, *map(len, texts)])
    together = chunks.chunk_starts(np.frombuffer(b"".join(texts), np.uint8), at)
    alone = [s + a for t, a in zip(texts, at) for s in chunks.chunk_starts(np.frombuffer(t, np.uint8), np.array([0, len(t)])).tolist()]
    assert together.tolist() == alone


def brute_spans(documents, min_run):
    """What a dictionary of chunks removes, per (id, text): runs of chunks that have an earlier place."""
    first, cut = {}, {}
    for i, text in sorted(set(documents), key=lambda d: (d[0], d[1])):
        flat = np.frombuffer(text, np.uint8)
        edges = [*chunks.chunk_starts(flat, np.array([0, len(flat)])).tolist(), len(flat)]
        cut[i, text] = list(zip(edges, edges[1:]))
        for a, b in cut[i, text]:
            first.setdefault(text[a:b], (i, text, a))
    found = {}
    for (i, text), pieces in cut.items():
        runs = []
        for a, b in pieces:
            if first[text[a:b]] != (i, text, a):
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        found[i, text] = [(a, b) for a, b in runs if b - a >= min_run]
    return found


def test_chunk_removal_against_brute_force(spark):
    """The same rows go whatever the partitions, and they are those a dictionary of chunks names."""
    documents = spark.read.parquet(table_path(DOCS, "documents")).select("doc_id", "text")
    want = brute_spans([(r["doc_id"], (r["text"] or "").encode()) for r in documents.collect()], chunks.MIN_RUN)
    want = {i: spans for (i, _), spans in want.items()}
    assert any(want.values())
    for parts in (1, 7, 13):
        found = chunks.deduplicate(documents.repartition(parts)).collect()
        assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["removed"]] for r in found} == want


def test_chunk_removal(odd, odd_rows):
    found = chunks.deduplicate(odd).collect()
    assert len(found) == len(odd_rows)
    texts = {(r["doc_id"], i): r for i, r in enumerate(found)}
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[4]["text"] is None and by_id[4]["n_removed"] == 0
    assert by_id[5]["text"] == "" and by_id[7]["n_removed"] == 0
    # the null id comes first, so its copy of the text stays and the others go
    assert by_id[1]["text"] == by_id[2]["text"] == ""
    assert [r["n_removed"] for r in found if r["doc_id"] is None] == [0, 0]
    # equal rows of one id are not compared with each other
    assert all(r["n_removed"] == 0 for r in found if r["doc_id"] == 9)
    passage = len(by_id[10]["text"].encode())
    assert by_id[10]["n_removed"] == 0 and by_id[11]["n_removed"] > 0.7 * passage
    assert texts and found[0]["digest"] == "x"  # other columns stay as they are
    for row in found:
        spans = [(s["start"], s["end"]) for s in row["removed"]]
        assert sum(b - a for a, b in spans) == row["n_removed"]


def test_chunk_removal_of_no_rows(none):
    assert chunks.deduplicate(none).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(text):
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_repetitive_texts():
    for text in ([0] * 50, [0, 1] * 30, [1, 0, 1, 1, 0] * 12, list(b"abracadabra" * 5), []):
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_windows():
    random = np.random.default_rng(9)
    shared = random.integers(0, 256, 260, dtype=np.uint8)
    texts = [np.concatenate([random.integers(0, 256, 40, dtype=np.uint8), shared[k:]]) for k in (0, 30, 70)]
    count = Counter(t[i : i + 200].tobytes() for t in texts for i in range(len(t) - 199))
    want = [[count[t[i : i + 200].tobytes()] > 1 for i in range(len(t) - 199)] for t in texts]
    assert [f.tolist() for f in suffixes.repeated_windows(texts)] == want


def brute_removal(texts):
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for body in bodies:
        gone = bytearray(len(body))
        for i in range(len(body) - 199):
            if count[body[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def removal(df):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in suffixes.remove_repeats(df).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_byte_removal_of_odd_rows(odd, odd_rows):
    want = [(i, *w) for (i, _, _), w in zip(odd_rows, brute_removal([t for _, t, _ in odd_rows]))]
    assert order(removal(odd)) == order(want)


def test_byte_removal_of_made_passages(spark):
    """Passages of many lengths, periodic text, and one passage in very many rows."""
    random = np.random.default_rng(4)
    letters = lambda n: "".join(map(chr, random.integers(97, 123, n)))
    hot, long = letters(230), letters(900)
    texts = [letters(60) + hot + letters(80) for _ in range(150)]
    texts += [letters(40) + long[a:b] + letters(40) for a, b in ((0, 300), (100, 299), (100, 301), (250, 900), (0, 900), (640, 845))]
    texts += ["ab" * 300, "xyz" * 250, letters(199), letters(200), letters(500) * 2]
    rows = list(enumerate(texts))
    got = removal(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert order(got) == order([(i, *w) for (i, _), w in zip(rows, brute_removal(texts))])


def test_byte_removal_of_documents(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents")).select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    assert order(removal(documents)) == order([(i, *w) for (i, _), w in zip(rows, brute_removal([t for _, t in rows]))])


def test_byte_removal_of_no_rows(none):
    assert removal(none) == []


def test_brute_force_links_both_ways():
    assert brute_components(sets_of([(1, "a b c d e"), (2, "A B C D E"), (3, "a b")])) == {1: 1, 2: 1, 3: 3}
