"""Language-model scores and nearest neighbours."""

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import DOCS, LOWER
from strata.llm import mixing, nearest
from strata.llm.blocks import Powers, table_path


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def held():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def check_base(rows, documents):
    tokens = [(i, (t or "").encode().translate(LOWER).split() + [None]) for i, t in documents]
    count = Counter(w for i, ws in tokens if not crc(i) for w in ws)
    total, size = sum(count.values()), len(count)
    want = sorted(
        (-1 if i is None else i, len(ws), sum(count[w] > 0 for w in ws), total,
         round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (size + 1))) for w in ws), 6)) for i, ws in tokens)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(math.isclose(g[4], w[4], rel_tol=1e-9, abs_tol=1e-5) for g, w in zip(got, want))


def test_scores_of_documents(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents"))
    rows = mixing.score_documents(documents, held()).collect()
    check_base(rows, [tuple(r) for r in documents.select("doc_id", "text").collect()])
    assert all(r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_scores_of_odd_rows(odd, odd_rows, none):
    rows = mixing.score_documents(odd, held()).collect()
    check_base(rows, [(i, t) for i, t, _ in odd_rows])
    again = {(r["doc_id"], r["score"]) for r in rows if r["doc_id"] == 9}
    assert len(again) == 1
    assert mixing.score_documents(none, held()).collect() == []


def test_scores_without_training(odd, odd_rows):
    rows = mixing.score_documents(odd, F.lit(True)).collect()
    assert len(rows) == len(odd_rows) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents"))
    return mixing.fit(documents.select(F.col("text").cast("binary").alias("body")))


def probability(model, texts):
    flat = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    return np.exp(mixing.mix(mixing.decisions(flat, at, model.code, Powers()), model.tables))


def test_what_follows_a_text_sums_to_one(model):
    """The end and the 256 next bytes share the probability of a beginning."""
    for start in (b"", b"Th", b"the quic"):
        one = probability(model, [start])[0]
        # the chance of a beginning is what all its continuations have, to any depth; compare two depths
        longer = [start + bytes([b]) for b in range(256)]
        symbols, place = mixing._symbols(np.frombuffer(start + b"x", np.uint8), np.array([0, len(start) + 1]))
        assert symbols[place[0]] == (start + b"x")[0]
        code = model.code
        paths = {tuple(code.bit[a : a + n]) for a, n in zip(code.begin[97 * 258 : 97 * 258 + 257], code.length[97 * 258 : 97 * 258 + 257])}
        assert len(paths) == 257 and abs(sum(2.0 ** -len(p) for p in paths) - 1) < 1e-12
        assert one + probability(model, longer).sum() < 1 + 1e-6


def test_a_score_does_not_depend_on_its_neighbours(model):
    texts = [b"The first text.", b"", "été à".encode(), b"x" * 9000]
    alone = [probability(model, [t])[0] for t in texts]
    assert np.allclose(np.log(np.maximum(alone, 1e-300)), np.log(np.maximum(probability(model, texts), 1e-300)), rtol=1e-6)


def test_weights_are_carried_over_a_whole_text(model):
    text = " ".join(f"the word{i % 7} of a text" for i in range(700)).encode()
    found = mixing.decisions(np.frombuffer(text, np.uint8), np.array([0, len(text)]), model.code, Powers())
    inputs = np.array([t[found.places(i, len(t))] for i, t in enumerate(model.tables)], np.float64) / mixing.SCALE
    gates, sign = (inputs[-2] != 0) + 2 * (inputs[-1] != 0), 2 * found.bits - 1
    weights, total = mixing.START.astype(np.float64), 0.0
    for at in range(0, len(sign), mixing.STEP):
        x, gate, y = inputs[:, at : at + mixing.STEP], gates[at : at + mixing.STEP], sign[at : at + mixing.STEP]
        miss = np.exp(-y * np.clip((x * weights[gate].T).sum(axis=0), -12, 12))
        total -= np.log1p(miss).sum()
        np.add.at(weights, gate, (x * (miss / (1 + miss) * y * mixing.RATE)).T)
    assert len(sign) > 4 * (1 << 13)
    assert math.isclose(mixing.mix(found, model.tables)[0], total, rel_tol=1e-4)


def brute_nearest(rows, k):
    fine = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    return {i: sorted(((-(v * w).sum(), j) for j, w in fine if j != i))[:k] for i, v in fine}


def test_nearest(spark):
    embeddings = spark.read.parquet(table_path(DOCS.replace("0.001", "0.01"), "embeddings"))
    rows = [tuple(r) for r in embeddings.select("vec_id", "embedding").collect()]
    want = brute_nearest(rows, 20)
    found = {}
    for r in nearest.search(embeddings, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (-r["score"], r["vec_id"])
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    hits = total = 0
    for query, ranks in found.items():
        assert sorted(ranks) == list(range(1, 21)) and [ranks[i] for i in range(1, 21)] == sorted(ranks.values())
        hits += len({j for _, j in ranks.values()} & {j for _, j in want[query]})
        total += 20
    assert hits / total >= 0.9


def test_nearest_of_odd_vectors(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=4).tolist()) for i in range(40)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0]) for i in range(100, 160)]  # many copies of one vector
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 1.0, 0.0, 0.0]),
             (205, [float("inf"), 0.0, 0.0, 0.0]), (206, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (7, rows[7][1])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, leaf int, rep string")
    want = brute_nearest([r for r in rows[:-1] if r[0] != 206], 5)
    found = {}
    for r in nearest.search(table, F.lit(True), k=5, target=1.0).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], round(-r["score"], 12), r["vec_id"]))
    assert {q: [(round(s, 12), j) for s, j in hits] for q, hits in want.items()} == {q: [h[1:] for h in sorted(hits)] for q, hits in found.items()}
    assert nearest.search(table.limit(0), F.lit(True)).collect() == []
    few = nearest.search(table.where("vec_id IN (1, 2, 3)"), F.col("vec_id") == 2).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 3]


def test_every_query_has_its_full_answer(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=4).tolist()) for i in range(300)] + [(i, (20 + random.normal(size=4) / 9).tolist()) for i in range(300, 500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.search(table, F.lit(True), target=0.01).groupBy("query_id").count().collect()
    assert len(found) == 500 and {r["count"] for r in found} == {20}


def test_tokens_are_dealt_in_little_memory(monkeypatch):
    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(mixing, "TaskContext", type("Context", (), {"get": staticmethod(Task)}))
    body = [(f"Word{i % 97} other{i} words " * 150).encode() for i in range(1200)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(1200)), pa.array(range(1200)), pa.array([i % 5 != 1 for i in range(1200)]), pa.array(body, pa.binary())],
        ["doc_id", "row_digest", "training", "body"])
    tracemalloc.start()
    try:
        dealt = list(mixing._deal_tokens(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert batch.nbytes > 3e6 and len(dealt) == 1
    assert most < 100e6  # every byte of a slice was widened at once
    tokens = np.frombuffer(dealt[0]["tokens"][0].as_py(), np.uint64)
    times = np.frombuffer(dealt[0]["times"][0].as_py(), np.uint8)
    assert len(tokens) == 97 + 1200 + 1 + 1 and times.sum() == 1200 * (3 * 150 + 1)
