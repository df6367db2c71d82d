"""Spelling variants: words that differ by one code point, found with an index of variable-length grams.

A word stands between a start and an end mark. The gram at a place is the shortest run of at least two
characters from there that is no frequent one, at most ``longest`` characters: frequent runs are pruned
from the dictionary and replaced by longer ones. Where a gram stops depends on its own characters
alone, so a word and its variant have all grams in common that the edit does not touch. An edit can
affect at most the grams that lie over its place. Of two grams of a word that do not overlap it affects
one at most: this bound for the cheapest such pair of a word says which of its lists have to be merged,
and the lists hold length and place besides the gram. What the merged lists give is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.llm.common import body, rows_of, written

# The letters that are lowered, and the characters of a run.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_RUN = re.compile("[a-zÀ-ÿ]+")
_START, _END = "^", "$"  # no run holds them
_HELD = 200_000  # words or grams counted in a task before they are passed on
_LEAST_FREQUENT = 100  # a run of characters in more words than this is frequent
_INLINE = 64  # characters of a marked word that is carried in its lists; longer ones are looked up
_DICTIONARY = 1 << 17  # upper bound of the frequent runs sent to every task


def _counted(counts: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=[name, "n"])


def word_counts(docs: DataFrame, min_chars: int = 5, one_in: int = 97) -> DataFrame:
    """word, n: the lower-cased runs of letters, of which about ``one_in`` in a document and run lacks a letter.

    A run loses the code point that the crc32 of "doc_id:run" points at, if ``one_in`` divides that
    crc32. Only words of at least ``min_chars`` code points are counted. A null text has no words and a
    null doc_id is an empty one.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for rows in rows_of(parts):
            for name, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                seed = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
                    if len(run) >= min_chars:
                        h = zlib.crc32(run.encode(), seed)
                        if h % one_in == 0:
                            if len(run) == min_chars:
                                continue
                            at = h % len(run)
                            run = run[:at] + run[at + 1 :]
                        total[run] += n
                if len(total) > _HELD:
                    yield _counted(total, "word")
                    total = Counter()
        yield _counted(total, "word")

    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), body().alias("text"))
    return named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_runs(words: DataFrame, longest: int) -> dict[str, int]:
    """Runs of 2 to ``longest`` characters of marked words that are in too many words to be a gram, with that number.

    The least number grows with the words, so that no more than _DICTIONARY runs can reach it.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in parts:
            for word in batch.column(0).to_pylist():
                marked = f"{_START}{word}{_END}"
                total.update({marked[i : i + q] for q in range(2, longest + 1) for i in range(len(marked) - q + 1)})
                if len(total) > _HELD:
                    yield _counted(total, "run")
                    total = Counter()
        yield _counted(total, "run")

    counted = written(words.select("word").mapInArrow(count, "run string, n long").groupBy("run").agg(F.sum("n").alias("n")), "spelling-runs")
    least = max(_LEAST_FREQUENT, (counted.agg(F.sum("n")).first()[0] or 0) // _DICTIONARY)
    return {run: n for run, n in counted.where(F.col("n") > least).collect()}


def grams(marked: str, frequent: dict[str, int], longest: int) -> list[tuple[int, int]]:
    """Start and end of the gram at every place of a marked word but its last character."""
    size, out = len(marked), []
    for start in range(size - 1):
        end = start + 2
        while end < size and end - start < longest and marked[start:end] in frequent:
            end += 1
        out.append((start, end))
    return out


def cheapest_pair(marked: str, found: list[tuple[int, int]], frequent: dict[str, int]) -> tuple[int, int]:
    """Two grams that do not overlap, so that one edit affects one at most, with the shortest lists together."""
    cost = [frequent.get(marked[i:j], _LEAST_FREQUENT // 2) for i, j in found]
    best_after = list(range(len(found)))
    for k in range(len(found) - 2, -1, -1):
        if cost[best_after[k + 1]] < cost[k]:
            best_after[k] = best_after[k + 1]
    pairs = [(cost[k] + cost[best_after[j]], k, best_after[j]) for k, (_, j) in enumerate(found) if j < len(found)]
    return min(pairs)[1:]


def _list_number(gram: str, size: int, place: int) -> int:
    """The number of the list of a gram at a place of a word of some length; lists that share one only give more to verify."""
    return zlib.crc32(gram.encode()) << 31 | (size * 40_503 + place) & 0x7FFFFFFF


def _letters(word: str) -> int:
    """One bit for each letter of a word, some letters sharing one. One edit changes two bits at most."""
    bits = 0
    for letter in set(word):
        bits |= 1 << ord(letter) % 63
    return bits


def gram_lists(words: DataFrame, frequent: dict[str, int], longest: int) -> DataFrame:
    """number, probes, id, word, n, size, letters: every word in the lists of its grams, and the lists it has to look up.

    A variant of the same length has an unaffected gram at the same place, one that is a letter longer
    at the same or the next place. Shorter variants find the word from their side. Words that are too
    long to be repeated for each gram have a number instead of the word.
    """
    sent = words.sparkSession.sparkContext.broadcast(frequent)

    def index(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in rows_of(parts, 4096):
            columns: list[list] = [[] for _ in range(7)]
            for word, n, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marked = f"{_START}{word}{_END}"
                size, letters, found = len(marked), _letters(word), grams(marked, known, longest)
                numbers = [(_list_number(marked[i:j], size, i), False) for i, j in found]
                for k in cheapest_pair(marked, found, known):
                    i, j = found[k]
                    gram = marked[i:j]
                    numbers += [(_list_number(gram, size + more, i + shift), True) for more, shift in ((0, 0), (1, 0), (1, 1))]
                for column, values in zip(columns, zip(*numbers, strict=True), strict=False):
                    column.extend(values)
                own = number if size > _INLINE else None, word if size <= _INLINE + 1 else None
                for column, value in zip(columns[2:], (*own, n, size, letters), strict=True):
                    column.extend([value] * len(numbers))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64())
            names = ("number", "probes", "id", "word", "n", "size", "letters")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    named = words.select("word", "n", F.xxhash64("word").alias("id"))
    return named.mapInArrow(index, "number long, probes boolean, id long, word string, n long, size int, letters long")


def near_pairs(words: DataFrame, longest: int = 5) -> DataFrame:
    """a, a_n, b, b_n: every pair of different words one edit apart, once in each direction.

    ``words`` has word and n, each word once, of at least ``longest`` code points: then two grams that do
    not overlap always exist, and no word needs another way.
    """
    rows = written(gram_lists(words, frequent_runs(words, longest), longest), "spelling-lists")
    mine, lists = rows.where("probes"), rows.where("NOT probes")
    a = mine.select("number", *(F.col(c).alias(f"a_{c}") for c in ("id", "word", "n", "size", "letters")))
    b = lists.select("number", *(F.col(c).alias(f"b_{c}") for c in ("id", "word", "n", "size", "letters")))
    # The cheap tests come first; words of one length meet from both sides, and one side is enough.
    larger = F.col("b_size") == F.col("a_size") + 1
    apart = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2

    def one_side(column: str) -> Column:
        return larger | ((F.col("b_size") == F.col("a_size")) & (F.col(f"a_{column}") < F.col(f"b_{column}")))

    one_apart = F.levenshtein("a_word", "b_word", 1) == 1
    listed = a["number"] == b["number"]
    short = a.where(F.col("a_size") <= _INLINE), b.where(F.col("b_size") <= _INLINE + 1)
    found = short[0].join(short[1], listed & apart & one_side("word") & one_apart).select("a_word", "a_n", "b_word", "b_n")
    # Texts of long words are fetched once for a pair. Two words of one number would only be looked at needlessly.
    long = a.where(F.col("a_size") > _INLINE), b.where(F.col("b_size") > _INLINE)
    numbers = written(long[0].join(long[1], listed & apart & one_side("id")).select("a_id", "b_id").distinct(), "spelling-long")
    if not numbers.isEmpty():
        for x in "ab":
            texts = words.select(F.xxhash64("word").alias(f"{x}_id"), F.col("word").alias(f"{x}_word"), F.col("n").alias(f"{x}_n"))
            numbers = numbers.join(texts, f"{x}_id")
        found = found.unionByName(numbers.where(one_apart).select(found.columns))
    once = written(found.distinct(), "spelling-pairs")
    names = ["a", "a_n", "b", "b_n"]
    return once.toDF(*names).unionByName(once.toDF("b", "b_n", "a", "a_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, where ``forms`` (word, form) lead to: each round doubles the steps that are taken at once.

    A form occurs at least twice as often as its word, so no chain has a circle or over 63 steps.
    """
    links = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        further = links.join(onward, links["root"] == onward["_word"], "left")
        if further.where("_root IS NOT NULL").isEmpty():
            return links
        links = written(further.select("word", F.coalesce("_root", "root").alias("root")), "spelling-roots")


def variants(words: DataFrame, longest: int = 5, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n for each of ``words`` (word, n).

    ``form`` is the near word that occurs most often (the smallest of several), if it does so at least
    ``times`` as often as the word; ``root`` is where the forms lead from the word, itself if it has none.
    """
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"), F.col("b_n").alias("form_n")))
    near = near_pairs(words, longest).groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    strong = F.col("best.form_n") >= times * F.col("n")
    described = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *(F.when(strong, F.col(f"best.{c}")).alias(c) for c in ("form", "form_n")),
    )
    described = written(described, "spelling-forms")
    root = roots(described.where("form IS NOT NULL"))
    joined = described.join(root, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_chars: int = 5, min_count: int = 3, one_in: int = 97, times: int = 2) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text) that have ``min_chars`` code points and occur ``min_count`` times.

    Whole texts are read; a null text has no words. Rows that repeat count as often as they occur.
    No word gives no row. Other columns are not read.
    """
    words = word_counts(docs, min_chars, one_in).where(F.col("n") >= min_count)
    return variants(written(words, "spelling-words"), min_chars, times)
