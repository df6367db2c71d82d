from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np

from cartpath.llm import ngram_rules, quality, queries
from cartpath.llm.ngram_rules import ADDED, STATISTICS, Counts, Words, apply_rules, fit


def plain_base(text) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    counts = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = [False] * len(words)
    for i in range(len(words) - 2):
        if counts[tuple(words[i : i + 3])] > 1:
            marked[i : i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(marked)


def plain_scores(docs: list[tuple], trusted: set, buckets: int, smoothing: float) -> list[float]:
    """Each document against counts over the others, in a dictionary."""
    grams = [Words([(text or "").encode()]).ngrams(buckets)[1].tolist() for _, text in docs]
    raw, good = Counter(), Counter()
    for (doc_id, _), own in zip(docs, grams, strict=True):
        raw.update(own)
        if doc_id in trusted:
            good.update(own)
    out = []
    for (doc_id, _), own in zip(docs, grams, strict=True):
        mine = Counter(own)
        theirs = mine if doc_id in trusted else Counter()
        n_raw, n_good = raw.total() - mine.total(), good.total() - theirs.total()
        if not own or n_good <= 0:
            out.append(0.0)
            continue
        flat = smoothing * buckets
        parts = [math.log((good[g] - theirs[g] + smoothing) / (n_good + flat)) - math.log((raw[g] - mine[g] + smoothing) / (n_raw + flat)) for g in own]
        out.append(sum(parts) / len(parts))
    return out


def test_against_plain_version(spark):
    """Whole table: base counts, scores, threshold and verdicts."""
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.documents(spark, folder).collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    trusted = {r.doc_id for r in labels.where("quality = 1").where(~quality.held_out()).collect()}
    found = {r.doc_id: r for r in queries.quality_rules(spark, folder).collect()}
    scores = plain_scores(docs, trusted, 1 << 18, 1.0)
    base = [plain_base(text) for _, text in docs]
    failed = [b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base]
    steps = sorted(math.floor(s * 1000) for (d, _), s, f in zip(docs, scores, failed, strict=True) if d in trusted and not f)
    threshold = steps[int(0.01 * len(steps))] / 1000 - 0.2
    for (doc_id, _), b, f, s in zip(docs, base, failed, scores, strict=True):
        row = found[doc_id]
        assert tuple(row[c] for c in STATISTICS) == b
        assert row.base_failed == f
        assert abs(row.score - s) < 1e-9
        assert row.kept == (not f and s >= threshold)
    assert len(found) == len(docs)


def test_held_out_labels(spark):
    """Held-out good documents stay, held-out bad ones go."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(quality.held_out())
    judged = queries.quality_rules(spark, folder).where("NOT base_failed").join(labels, "doc_id").toPandas()
    assert judged[judged.quality == 1].kept.mean() > 0.98
    assert judged[judged.quality == 0].kept.mean() < 0.05


def test_the_deal_of_rows_changes_nothing(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs = queries.documents(spark, folder)
    trusted = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    first = sorted(tuple(r) for r in apply_rules(docs, trusted, with_text=False).collect())
    monkeypatch.setattr(ngram_rules, "IDS_TO_SEND", 0)
    again = apply_rules(docs.repartition(7, "text"), trusted.union(trusted).repartition(3), with_text=False)
    assert sorted(tuple(r) for r in again.collect()) == first


def test_edge_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(300_000))
    texts = [None, "", " \n\t", "a b c a b c", "é é x\x0bx", "same line\nsame line\n\nsame line\n \n ", "#*$%&|<> # w", long_text, long_text]
    rows = [(i, t, "clash", i) for i, t in enumerate(texts)] + [(None, "no id " * 60, "clash", 0), (3, "a b c a b c", "clash", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    trusted = spark.createDataFrame([(7,), (None,), (99,)], "doc_id long")
    found = apply_rules(docs, trusted).collect()
    assert len(found) == len(rows)
    assert [c for c in found[0].asDict()] == ["doc_id", "text", *ADDED]
    by_text = {(r.doc_id, r.text): r for r in found}
    for doc_id, text, *_ in rows:
        assert tuple(by_text[doc_id, text or ""][c] for c in STATISTICS) == plain_base(text)
    assert by_text[None, "no id " * 60].base_failed
    assert by_text[8, long_text].kept
    nobody = apply_rules(docs, trusted.where("doc_id < 0"), with_text=False).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in nobody)
    assert apply_rules(docs.where("false"), trusted).count() == 0


def test_counts_cover_all_rows(spark):
    docs = spark.createDataFrame([(i, f"word{i % 10} other") for i in range(1000)], "doc_id long, text string")
    counts = fit(docs, docs.where("doc_id < 100").select("doc_id"), buckets=1 << 12)
    assert (int(counts.raw.sum()), int(counts.trusted.sum())) == (3000, 300)
    alone = Counts(np.zeros(4, np.int64), np.zeros(4, np.int64), 1.0)
    assert alone.scores(2, np.zeros(0, np.int64), np.zeros(0, np.int64), False).tolist() == [0.0, 0.0]
