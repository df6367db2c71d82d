"""Quality rules: base counts of a text, and a log-likelihood ratio of its hashed n-grams.

Words and pairs of words are hashed into a fixed number of buckets. One multinomial over the buckets is
counted over all trusted documents and one over the raw corpus; the score of a document is the mean
over its n-grams of log(trusted / raw). A document's own n-grams are taken out of both counts before it
is scored, so that being trusted, or being a large part of a small corpus, does not lift or lower its
score. The threshold lies a margin below what nearly all trusted documents reach. Counts are whole
numbers, the distribution of the trusted scores is a histogram, and each document is summed by itself,
so a verdict does not depend on how the rows are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpath.llm.common import body, rows_of
from cartpath.llm.words import hashes, windows

# What separates words, what counts as a symbol, the letters that are lowered for n-grams.
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_SPACE_BYTE = np.isin(np.arange(256), list(SPACE))
_CHUNK = 1 << 21  # bytes of texts looked at together; a longer text is looked at alone
_HELD = 1 << 20  # n-grams kept before they are counted
_STEPS = 1000  # steps of the histogram for a difference of 1 in the score
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*STATISTICS, "base_failed", "score", "kept")
IDS_TO_SEND = 2_000_000  # of trusted documents, sent to all tasks up to here; beyond, the texts are joined


class Words:
    """The words of some texts, as spans of the texts laid end to end with a space between."""

    def __init__(self, texts: list[bytes]):
        self.n = len(texts)
        self.joined = b" ".join(texts)
        inside = np.zeros(len(self.joined) + 2, np.int8)
        inside[1:-1] = ~_SPACE_BYTE[np.frombuffer(self.joined, np.uint8)]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[0::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text = np.searchsorted(begins, self.starts, side="right") - 1

    def hashed(self, lower: bool) -> np.ndarray:
        data = self.joined.translate(_LOWER) if lower else self.joined
        return hashes(np.frombuffer(data, np.uint8), self.starts, self.ends)

    def runs(self, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where ``size`` words of one text follow each other, and the hash of each such run."""
        if len(values) < size:
            return np.zeros(0, np.int64), values[:0]
        whole = np.flatnonzero(self.text[: len(values) - size + 1] == self.text[size - 1 :])
        return whole, windows(values, size)[whole]

    def ngrams(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """For each word and each pair of words the text and the bucket."""
        words = self.hashed(lower=True)
        places, pairs = self.runs(words, 2)
        bucket = np.concatenate([words, pairs]) % np.uint64(buckets)
        return np.concatenate([self.text, self.text[places]]), bucket.astype(np.int64)

    def repeats(self) -> np.ndarray:
        """For each text the words inside three-word runs that it holds twice or more."""
        places, hashed = self.runs(self.hashed(lower=False), 3)
        owner = self.text[places]
        order = np.lexsort((hashed, owner))
        same = np.zeros(len(order) + 1, bool)  # whether a run equals the one before it in this order
        same[1:-1] = (hashed[order[1:]] == hashed[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = places[order[same[:-1] | same[1:]]]
        within = np.zeros(len(self.starts), bool)
        for k in range(3):
            within[twice + k] = True
        return np.bincount(self.text[within], minlength=self.n)


def _line_counts(text: bytes) -> tuple[int, int, int]:
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    chars = len(text.translate(None, SPACE + _FOLLOWING))
    return chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines))


def base_counts(texts: list[bytes], words: Words) -> np.ndarray:
    """The values of STATISTICS, a row for each text."""
    by_line = np.array([_line_counts(text) for text in texts], np.int64).reshape(-1, 3)
    n_words = np.bincount(words.text, minlength=len(texts))
    return np.column_stack([n_words, by_line, words.repeats()]).astype(np.int64)


@dataclass
class Counts:
    """Bucket counts of the trusted and of all documents, and the least score that is kept."""

    trusted: np.ndarray
    raw: np.ndarray
    smoothing: float
    threshold: float = 0.0
    totals: tuple[int, int] = field(init=False)

    def __post_init__(self):
        self.totals = int(self.trusted.sum()), int(self.raw.sum())

    def scores(self, texts: int, owner: np.ndarray, bucket: np.ndarray, is_trusted: bool) -> np.ndarray:
        """Mean log ratio for each text, its own share of the counts left out; 0 without n-grams or trusted text."""
        size = np.bincount(owner, minlength=texts)
        own = size if is_trusted else np.zeros(texts, np.int64)
        pair, times = np.unique(owner * len(self.raw) + bucket, return_counts=True)
        of, at = np.divmod(pair, len(self.raw))
        flat = self.smoothing * len(self.raw)
        ratio = np.log(np.maximum(self.trusted[at] - (times if is_trusted else 0), 0) + self.smoothing)
        ratio -= np.log(np.maximum(self.raw[at] - times, 0) + self.smoothing)
        total = np.bincount(of, weights=ratio * times, minlength=texts)
        left_trusted, left_raw = self.totals[0] - own, self.totals[1] - size
        shift = np.log(np.maximum(left_raw, 0) + flat) - np.log(np.maximum(left_trusted, 0) + flat)
        return np.where((size > 0) & (left_trusted > 0), total / np.maximum(size, 1) + shift, 0.0)


def _chunks(texts: list[bytes]) -> Iterator[slice]:
    """Slices of the texts of about _CHUNK bytes."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def count_ngrams(docs: DataFrame, buckets: int) -> np.ndarray:
    """Bucket counts over all rows; every task sends one number per bucket, and these are summed before the driver sees them."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(buckets, np.int64), [], 0
        for rows in rows_of(parts):
            texts = rows.column(0).to_pylist()
            for cut in _chunks(texts):
                held.append(Words(texts[cut]).ngrams(buckets)[1])
                size += len(held[-1])
                if size >= _HELD:
                    total += np.bincount(np.concatenate(held), minlength=buckets)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    made = docs.select(body().alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in made.collect():
        counts[bucket] = n
    return counts


def _judged(docs: DataFrame, counts: Counts, with_text: bool = False) -> DataFrame:
    """``docs`` with STATISTICS and both scores: of a document that is trusted, and of one that is not."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    buckets = len(counts.raw)
    others = [n for n in docs.columns if n != "text"]
    keep = [*others, "text"] if with_text else others
    scores = ("_score_outside", "_score_inside")

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for rows in rows_of(parts):
            texts = rows.column(len(others)).to_pylist()
            base, found = [np.zeros((0, len(STATISTICS)), np.int64)], [np.zeros((0, 2))]
            for cut in _chunks(texts):
                part = texts[cut]
                words = Words(part)
                base.append(base_counts(part, words))
                owner, bucket = words.ngrams(buckets)
                found.append(np.column_stack([model.scores(len(part), owner, bucket, inside) for inside in (False, True)]))
            table = [*np.concatenate(base).T, *np.concatenate(found).T]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[: len(keep)], *(pa.array(np.ascontiguousarray(c)) for c in table)], names=[*keep, *STATISTICS, *scores]
            )

    source = docs.select(*others, body().alias("text"))
    out = source.select(*keep).schema
    for name in STATISTICS:
        out = out.add(name, "long")
    for name in scores:
        out = out.add(name, "double")
    return source.mapInArrow(judge, out)


def _base_failed(min_words: int, max_repeat_percent: int):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = 1 << 18,
    smoothing: float = 1.0,
    share: float = 0.01,
    margin: float = 0.2,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> Counts:
    """Count the n-grams of all documents, and of those whose doc_id is in ``trusted`` (doc_id); set the threshold.

    The threshold is ``margin`` below the score that all but ``share`` of the trusted documents which pass
    the base rules reach, in steps of a thousandth. The driver receives a number per bucket and one
    per step. Null ids are in no list.
    """
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    if ids.count() <= IDS_TO_SEND:
        ids = F.broadcast(ids)
    chosen = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    counts = Counts(count_ngrams(chosen, buckets), count_ngrams(docs, buckets), smoothing)
    passed = _judged(chosen.select("text"), counts).where(~_base_failed(min_words, max_repeat_percent))
    steps = sorted(passed.groupBy(F.floor(F.col("_score_inside") * _STEPS).alias("step")).count().collect())
    left = share * sum(n for _, n in steps)
    for step, n in steps:
        left -= n
        if left < 0:
            counts.threshold = step / _STEPS - margin
            break
    return counts


def apply_rules(docs: DataFrame, trusted: DataFrame, with_text: bool = True, min_words: int = 50, max_repeat_percent: int = 50, **options) -> DataFrame:
    """``docs`` with the columns of ADDED; every row is judged.

    ``word_chars`` are the code points in words, ``n_symbols`` the characters of SYMBOLS, ``n_dup_lines``
    the lines with a word that equal an earlier line, ``n_repeat_words`` the words inside three-word
    windows that occur twice or more in the text. ``base_failed`` holds for fewer than ``min_words`` words,
    or if more than ``max_repeat_percent`` of them repeat. ``kept`` holds for the others whose ``score``
    reaches the threshold of ``fit``, to which ``options`` go. A null text is an empty one, which fails.
    Without trusted text every score is 0 and so is the threshold: only the base rules judge. Rows that
    repeat are judged alike, a row without doc_id is never trusted, and input columns named like an
    added one are replaced. Without ``with_text`` the texts are left out of the result.
    """
    counts = fit(docs, trusted, min_words=min_words, max_repeat_percent=max_repeat_percent, **options)
    names = [n for n in docs.columns if n not in ADDED]
    judged = _judged(docs.select(*names), counts, with_text)
    own = trusted.select(F.col("doc_id").alias("_trusted")).where("_trusted IS NOT NULL").distinct()
    scored = judged.join(own, judged["doc_id"] == own["_trusted"], "left")
    scored = scored.withColumn("score", F.when(F.col("_trusted").isNotNull(), F.col("_score_inside")).otherwise(F.col("_score_outside")))
    failed = _base_failed(min_words, max_repeat_percent)
    scored = scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= counts.threshold))
    if with_text:
        scored = scored.withColumn("text", F.col("text").cast("string"))
    return scored.select(*(n for n in names if with_text or n != "text"), *ADDED)
