from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from cartpath.llm import oracle, queries
from cartpath.llm.spelling import cheapest_pair, grams, near_pairs, spelling_variants, variants
from compare import oracle_rows, spark_rows


def plain_words(docs, min_chars=5, min_count=3, one_in=97):
    counts = Counter()
    for doc_id, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words: dict[str, int], times=2) -> set:
    near = defaultdict(list)
    for a in words:
        for b in words:
            if one_apart(a, b):
                near[a].append(b)
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda b: (-words[b], b), default=None)
        form[word] = best if best and words[best] >= times * n else None
    out = set()
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), words[form[word]] if form[word] else None))
    return out


def rows(found) -> list[tuple]:
    return sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    expected = plain_variants(plain_words([tuple(r) for r in docs.collect()], min_count=5))
    assert set(rows(spelling_variants(docs, min_count=5))) == expected
    assert len(expected) > 500


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    assert spark_rows(queries.spellings(spark, folder)) == oracle_rows(connection, oracle.SPELLINGS)


def test_frequent_runs_and_a_hot_list(spark, monkeypatch):
    """Thousands of words of one beginning or ending: their runs are pruned, and nothing is lost."""
    monkeypatch.setattr("cartpath.llm.spelling._LEAST_FREQUENT", 5)
    letters = "abcdefgh"
    made = {f"pre{a}{b}{c}tion": 3 for a in letters for b in letters for c in letters}
    made |= {"prefaation": 9, "präabction": 5, "preabctions": 7, "xpreabction": 4, "÷÷÷÷÷": 3, "÷÷×÷÷": 8}
    words = spark.createDataFrame(list(made.items()), "word string, n long")
    assert set(rows(variants(words))) == plain_variants(made)


@pytest.mark.parametrize("word", ["abcde", "aaaaa", "äöüäö", "abcdefghijkl"])
@pytest.mark.parametrize("frequent", [{}, {"aa": 900, "^a": 700, "^ab": 500, "^abc": 300, "e$": 999}])
def test_an_edit_leaves_one_gram_of_the_pair(word, frequent):
    """The bound by which lists are left out, for every edit of a word."""
    marked = f"^{word}$"
    found = grams(marked, frequent, 5)
    pair = [found[k] for k in cheapest_pair(marked, found, frequent)]
    assert pair[0][1] <= pair[1][0]
    edits = {word[:i] + c + word[i + d :] for i in range(len(word) + 1) for c in ("", "z", "a") for d in (0, 1)} - {word}
    for other in edits:
        if one_apart(word, other) and len(other) >= len(word):
            theirs = {(f"^{other}$"[i:j], i) for i, j in grams(f"^{other}$", frequent, 5)}
            assert any((marked[i:j], i + s) in theirs for i, j in pair for s in (0, len(other) - len(word)))


def test_long_words(spark):
    """Words about the length from which lists hold numbers instead of words."""
    made = {}
    for size in range(60, 68):
        word = "".join(chr(97 + i * 7 % 26) for i in range(size))
        made |= {word: size, word[:30] + "é" + word[31:]: 200 + size, word[1:]: 5, word + "q": 400}
    assert set(rows(variants(spark.createDataFrame(list(made.items()), "word string, n long")))) == plain_variants(made)


def test_chains_of_forms(spark):
    made = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "bbbbbb": 64, "ccccc": 7}
    assert set(rows(variants(spark.createDataFrame(list(made.items()), "word string, n long")))) == plain_variants(made)


def test_edge_rows(spark):
    texts = [
        (1, None),
        (2, ""),
        (None, "Straße straße STRASSE straße"),
        (None, "Straße straße STRASSE straße"),
        (3, "Straße,straße;strasse\nstrassen ÉCOLE École école ÉCole"),
        (3, "Straße,straße;strasse\nstrassen ÉCOLE École école ÉCole"),
        (4, "colour color colours 123 a_b " * 50 + "x" * 200_000),
        (5, "x" * 200_000 + " " + "x" * 200_000),
    ]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in texts], "doc_id long, text string, word string, n long")
    found = rows(spelling_variants(docs))
    assert set(found) == plain_variants(plain_words(texts))
    assert any(len(r[0]) >= 199_999 for r in found)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).count() == 0
    assert near_pairs(spark.createDataFrame([("only", 1), ("alone", 2)], "word string, n long").where("n > 1")).count() == 0
