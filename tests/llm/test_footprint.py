"""What operators leave in the scratch folder, and send twice."""

import pytest

from strata.llm import chunks, near_duplicates as module
from strata.llm.near_duplicates import near_duplicates
from strata.workspace import application_scratch, discard, materialize


def stored(spark):
    """Label and name of each stored step."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(application_scratch(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in files.listStatus(folder)} if files.exists(folder) else set()


def left(spark, work):
    """(what the work returns, labels of the steps that it leaves stored)."""
    before = stored(spark)
    return work(), sorted(name.rpartition("-")[0] for name in stored(spark) - before)


def test_near_duplicates_leave_only_their_result(spark, odd, none):
    for docs, count in ((odd, odd.count()), (none, 0)):
        found, steps = left(spark, lambda: near_duplicates(docs))
        assert steps == ["near-duplicates"] and found.count() == count


def test_near_duplicates_send_few_texts_and_each_set_once(spark, monkeypatch):
    plans = {}

    def stored_with_plan(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, label)

    monkeypatch.setattr(module, "materialize", stored_with_plan)
    copies = [(i, " ".join(f"w{j}" for j in range(200)) + f" end{i}") for i in range(300)]  # more than a centre meets in one place
    others = [(i, f"text{i} " * 4 + f"of{i} its{i} own{i}") for i in range(1000, 3000)]
    docs = spark.createDataFrame(copies + others + [(None, copies[0][1])], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert found == {i: 0 for i, _ in copies} | {i: i for i, _ in others} | {None: None}
    # every text went to the join, and every set twice
    assert plans["every-set"].count("MapInArrow") == 2
    assert sum("shingles" in line for line in plans["links"].splitlines() if "Relation [" in line) == 1
    texts = docs.selectExpr("doc_id AS rep", "CAST(text AS binary) AS __text")
    few = [r["rep"] for r in module._perhaps_wanted(texts, spark.range(5).toDF("rep")).collect()]
    assert {0, 1, 2, 3, 4} <= set(few) and len(few) < 100


def test_chunks_leave_only_spans(spark, odd, none):
    for docs, count in ((odd, odd.count()), (none, 0)):
        found, steps = left(spark, lambda: chunks.deduplicate(docs))
        assert steps == ["spans"] and found.count() == count


def test_texts_are_sent_once(odd):
    plan = chunks.deduplicate(odd)._jdf.queryExecution().optimizedPlan().toString()
    sent = plan[plan.index("Join LeftOuter"):].splitlines()[1]
    assert "AS __text" in sent and ", text#" not in sent, sent


def test_only_stored_steps_are_discarded(spark, odd, tmp_path):
    odd.write.parquet(path := str(tmp_path / "given"))
    given = spark.read.parquet(path)
    with pytest.raises(ValueError, match="not a stored step"):
        discard(given)
    step = materialize(given, "step")
    assert step.count() == given.count()
    discard(step)
    assert not any(name.startswith("step-") for name in stored(spark)) and given.count() > 0
