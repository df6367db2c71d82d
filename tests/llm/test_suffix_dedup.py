from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartpath.llm import induced_sort, suffix_dedup
from cartpath.llm.suffix_dedup import dedup_substrings
from tests.llm.brute import repeated_bytes


def result(docs, **options):
    rows = dedup_substrings(docs, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("sha")).collect()
    return Counter(tuple(r) for r in rows)


def expected(rows, length):
    return Counter((d, *r) for (d, _), r in zip(rows, repeated_bytes([t for _, t in rows], length), strict=True))


@pytest.mark.parametrize("memory", [100, 1 << 20])
def test_sorter_finds_what_counting_finds(memory):
    rng = random.Random(3)
    for _ in range(60):
        letters = rng.choice([1, 2, 4, 256])
        strings = [bytes(rng.randrange(letters) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        strings += [strings[0] * 2] * rng.randint(0, 1)
        length = rng.choice([1, 2, 5, 9])
        counts = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        wanted = {(k, i) for k, s in enumerate(strings) for i in range(len(s) - length + 1) if counts[s[i : i + length]] > 1}
        owner, place = induced_sort.repeated(strings, length, memory)
        assert set(zip(owner.tolist(), place.tolist(), strict=True)) == wanted


def test_sorted_suffixes():
    strings = [b"banana", b"ananas", b"banana"]
    text = b"".join(s + b"\0" for s in strings)
    order = [int(p) for part, _ in induced_sort.suffixes(strings, 50) for p in part][::-1]
    # A closing 0 compares by its place.
    assert order == sorted(range(len(text)), key=lambda i: ([b + 1 for b in text[i : text.index(b"\0", i)]], text.index(b"\0", i)))


@pytest.mark.parametrize("hot_anchor", [0, 2, 1000])
def test_small_alphabets_and_hot_anchors(spark, hot_anchor):
    rng = random.Random(5)
    passage = "".join(rng.choice("abc ") for _ in range(60))
    rows = [(None, None), (1, ""), (2, "x"), (3, "é" * 80), (3, "ab" * 100), (4, passage), (4, passage)]
    for i in range(40):
        noise = "".join(rng.choice("defg é") for _ in range(rng.randint(0, 80)))
        rows.append((10 + i, noise + passage[: rng.randint(5, 60)] + noise[::-1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(docs, length=20, gram=6, hot_anchor=hot_anchor, shard_bytes=300, memory=500) == expected(rows, 20)


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    table = pq.read_table(folder, columns=["doc_id", "text"]).slice(0, 500)
    rows = [(r["doc_id"], r["text"]) for r in table.to_pylist()]
    docs = spark.read.parquet(folder).where(F.col("doc_id").isin([d for d, _ in rows]))
    assert result(docs) == expected(rows, 200)


def test_empty_table_and_other_columns(spark):
    assert dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a" * 30, 5, "x")], "doc_id long, text string, anchor int, row string")
    assert [tuple(r)[:4] for r in dedup_substrings(docs, length=10, gram=4).collect()] == [(1, 30, 30, 1)]


def test_positions_are_narrow_and_results_the_same():
    """Positions of a text that is not huge take four bytes in the sort, in its queues and where these spill."""
    import tracemalloc

    rng = np.random.default_rng(3)
    parts = [rng.integers(97, 123, 400, np.uint8).tobytes() for _ in range(60)]
    strings = [parts[a][b : b + 240] for a, b in zip(rng.integers(0, 60, 1500), rng.integers(0, 160, 1500), strict=True)]
    tracemalloc.start()
    owner, place = induced_sort.repeated(strings, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(map(len, strings))
    assert peak < 52 * size  # 65 before
    spilled = induced_sort.repeated(strings, 200, 1 << 16)
    assert np.array_equal(spilled[0], owner) and np.array_equal(spilled[1], place)
    seen = Counter(s[k : k + 200] for s in strings for k in range(len(s) - 199))
    assert list(zip(owner.tolist(), place.tolist(), strict=True)) == [(i, k) for i, s in enumerate(strings) for k in range(len(s) - 199) if seen[s[k : k + 200]] > 1]


def test_only_snippets_that_may_repeat_are_sorted():
    """No snippet with a window that is there twice is left out, wherever the anchor lies in it and however often."""
    rng = random.Random(7)
    left_out = 0
    for _ in range(300):
        length, gram = rng.choice([(20, 6), (9, 4), (12, 12), (5, 1)])
        anchor = bytes(rng.randrange(97, 99) for _ in range(gram))
        strings = [bytes(rng.randrange(97, 100) for _ in range(rng.randint(0, 30))) + anchor + bytes(rng.randrange(97, 100) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        strings += [s[rng.randint(0, 3) :] + b"z" for s in strings[:2]]
        strings = [s for s in strings if len(s) >= length and all(anchor in s[k : k + length] for k in range(len(s) - length + 1))]
        if not strings:
            continue
        marks = np.full(len(strings), suffix_dedup._Rolling(np.frombuffer(anchor, np.uint8)).all(gram)[0])
        may = suffix_dedup.meeting(marks, strings, length, gram)
        owner, _ = induced_sort.repeated(strings, length)
        assert may[owner].all()
        left_out += int((~may).sum())
    assert left_out > 20


def test_little_stays_on_disk(spark, tmp_path, monkeypatch):
    """Tables of steps that are done are deleted; the last step reads one list of places and the documents."""
    made = []
    given = suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda rows, purpose: made.append(given(rows, purpose)) or made[-1])
    docs = spark.createDataFrame([(i, "ab" * 30 + str(i) * 30) for i in range(20)], "doc_id long, text string")
    got = dedup_substrings(docs, length=20, gram=6)
    left = [table for table in made if os.path.exists(table._written_at.removeprefix("file:"))]
    assert len(made) >= 4 and len(left) == 1
    assert got.count() == 20
