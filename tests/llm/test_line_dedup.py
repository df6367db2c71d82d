from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq
import pytest

from cartpath.llm.line_dedup import LineRuns, dedup_lines, line_keys
from cartpath.session import work_path
from tests.llm.brute import kept_lines


def result(docs, **options):
    return Counter(tuple(r) for r in dedup_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", "text").collect())


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (7, 3)])
def test_edge_rows(spark, batches, fanout):
    common = "A line that many documents hold, ÄÖ"
    rows = [(i, f"own {i}\n \t{common.upper() if i % 2 else common}\r\n{common}\x0b") for i in range(9)]
    rows += [(None, common), (None, None), (20, None), (21, ""), (22, "\n\n"), (3, common), (30, "short\n" * 3 + common), (31, " " * 50)]
    rows += [(i, "kept below five docs, in four\n" + " " + common) for i in range(40, 44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs, min_docs=5, min_chars=20, batches=batches, fanout=fanout) == Counter(kept_lines(rows, 5, 20))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(folder, columns=["doc_id", "text"]).to_pylist()]
    assert result(spark.read.parquet(folder)) == Counter(kept_lines(rows, 5, 40))


def test_runs_tell_new_lines_and_merge(spark):
    runs = LineRuns(spark, work_path(spark, "runs"), fanout=2)
    keys = line_keys(spark.createDataFrame([(i, f"line {i % 3}\nline x{i}") for i in range(12)], "doc_id long, text string"), 1, 4)
    for batch in range(4):
        runs.add(keys.where(f"doc_id % 4 = {batch}"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    sums = runs.runs()
    assert sums.count() == 15
    assert sums.where("is_new").count() == 15
    assert sorted(r.n_docs for r in sums.collect())[-3:] == [4, 4, 4]
    again = runs.add(keys.where("doc_id = 0"))
    assert again.count() == 2
    assert again.where("is_new").count() == 0


def test_empty_table_and_other_columns(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a", 7, "b")], "doc_id long, text string, n_lines int, h1 string")
    row = dedup_lines(docs).first().asDict()
    assert row == {"doc_id": 1, "text": "a", "h1": "b", "n_lines": 1, "n_dropped": 0}
