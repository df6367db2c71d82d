from __future__ import annotations

import os

from pyspark.sql import functions as F

import corpus_pipeline
from cartpath.llm import near_dup
from cartpath.llm.common import durable, release, written

FOLDER = "/root/testdata/sf0.01"
EDGES = [(None, None, None, None, None), (None, "a b", "en", None, 3), (1, "", "en", "s", 0), (2, "one two three", None, "s", 13), (2, "one two three", None, "s", 13)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_each_stage_on_edge_rows(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "1 AS score", "2 AS id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        assert out.where("doc_id IS NULL").count() == 2, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
    assert corpus_pipeline.pack_sequences(spark, docs, FOLDER).count() == len(EDGES)


def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), "test-stage")
        after = docs.count()
        assert 0.5 * before < after <= before
        before = after
    packed = corpus_pipeline.pack_sequences(spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


def test_statistics_are_counted_once_per_document(spark):
    """The verdict is read from what was written: a filter on it does not bring the rules into its own condition."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.keep_quality(spark, docs, FOLDER)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_count" not in plan and "predicted" in plan


def test_operators_leave_no_step_behind(spark, monkeypatch):
    """What near duplicates write on the way is deleted, and nothing exchanged for a written table stays on disk."""
    made = []
    given = near_dup.written
    monkeypatch.setattr(near_dup, "written", lambda rows, purpose: made.append(given(rows, purpose)) or made[-1])
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    classes = near_dup.near_duplicates(docs)
    left = [table for table in made if os.path.exists(table._written_at.removeprefix("file:"))]
    assert len(made) > 8 and len(left) <= 2
    assert classes.count() == docs.count()


def test_exchanged_files_go_with_the_plan(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    tables = written(rows, "test-table"), durable(rows)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before
    assert all(sorted(t.collect()) == sorted((k, 100) for k in range(10)) for t in tables)
    release(tables[0])
    assert not os.path.exists(tables[0]._written_at)
