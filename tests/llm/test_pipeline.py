"""The pipeline's stages, each against a brute-force version on its own input."""

import corpus_pipeline as pipeline
from brute import DOCS, brute_components, sets_of
from strata.llm.blocks import table_path
from strata.llm.catalog import QUERIES


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(table_path(DOCS, "documents"))
    benchmark = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(table_path(DOCS, "benchmark")).collect()]
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "decontaminate", "bpe"]
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, DOCS).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        if name != "bpe":
            assert docs.columns == list(pipeline.COLUMNS)
            after = {r["doc_id"]: r["text"] for r in rows}
            assert len(after) == len(rows) and set(after) <= set(before)
        if name == "language_id":
            assert len(after) > 0.95 * len(before)
        if name == "near_duplicates":
            want = brute_components(sets_of(before.items()))
            assert set(after) == {i for i, c in want.items() if i == c}
        if name == "substring_dedup":
            assert set(after) == set(before) and all(len(after[i]) <= len(before[i]) for i in after)
        if name == "decontaminate":
            leaks = {i for i, t in before.items() if any(b in " ".join(t.lower().split()) for b in benchmark)}
            assert not leaks & set(after)
            assert len(set(before) - set(after)) <= len(leaks) + 2
        if name == "bpe":
            assert {r["doc_id"] for r in rows} == set(before) and docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_odd_documents(spark, odd, none):
    docs = odd
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, DOCS)
    found = sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] is not None)
    assert len(found) == len(set(found)) and {4, 5, 6}.isdisjoint(found)
    docs = none
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, DOCS)
    assert docs.collect() == []


def test_run_and_names(spark):
    assert pipeline.run(spark, DOCS).count() > 100
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
