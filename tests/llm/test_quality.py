from __future__ import annotations

import zlib

import pytest

from cartpath.llm import quality
from cartpath.llm.queries import quality_classifier

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in quality_classifier(spark, FOLDER).collect()}
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    tested = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    good = [p for p, q in tested if q == 1]
    bad = [p for p, q in tested if q == 0]
    assert sum(good) / len(good) >= 0.99
    assert 1 - sum(bad) / len(bad) >= 0.95


def test_edge_texts(spark):
    model = quality.RuleModel(0.5, ((((0, True, 2.0), (3, False, 0.1)), -2.0),))
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "AB", 1), (3, "a" * 300_000, 1)], "doc_id long, text string, score int")
    scores = {r.doc_id: round(r.score, 6) for r in quality.score(docs, model).collect()}
    plain, ruled = 0.622459, 0.182426
    assert scores == {None: plain, 1: plain, 2: ruled, 3: plain}


@pytest.mark.parametrize(("labels", "low", "high"), [([], 0.5, 0.5), ([(1, 1), (2, 1)], 0.9, 1), ([(1, 0), (2, None)], 0, 0.1)])
def test_too_few_labels(spark, labels, low, high):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    assert all(low <= r.score <= high for r in quality.score(docs, model).collect())


def test_learning_takes_few_tasks(spark, monkeypatch):
    """However finely the learned rows are dealt out, the many steps of learning run in a few tasks each."""
    frame = type(spark.range(0))
    dealt = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *columns: dealt(self, 40, *columns))
    texts = [(i, ("Some words, in a sentence. " if i % 3 else "a|b|c!! ") * (1 + i % 7), int(i % 3 > 0)) for i in range(200)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, label int")
    context = spark.sparkContext
    context.setJobGroup("learning", "learning")
    try:
        quality.fit(rows.select("doc_id", "text"), rows.select("doc_id", "label"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("learning")]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs if j for s in j.stageIds if tracker.getStageInfo(s)]
    assert len(jobs) > 20
    assert sorted(tasks)[-len(tasks) // 4] <= 4
