from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from cartpath.llm import decontaminate, words
from cartpath.llm.decontaminate import contaminated
from cartpath.llm.queries import decontamination

ITEM = "A train leaves Boston at 60 miles and meets Alice after 3 hours near the old stone bridge in the valley today"


def pairs(spark, texts: dict, items: dict, **options) -> dict:
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS window").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS place")
    return {(r.doc_id, r.item_id): r.reparameterised for r in contaminated(docs, bench, **options).collect()}


def test_templates_and_slots(spark):
    texts = {
        1: f"Before. {ITEM} and after.",
        2: "Hello. " + ITEM.replace("60", "75").replace("Boston", "Paris").replace("Alice", "Bob").replace("3 hours", "four minutes"),
        3: ITEM.replace("Boston", "Paris").replace("60", "3"),  # 60 and 3 would both be 3
        4: ITEM.lower(),
        5: ITEM[: len(ITEM) // 2],
        6: "Nothing of this kind is here at all, only 60 miles.",
        7: None,
        8: "",
        9: (ITEM + "\n") * 300,
    }
    got = pairs(spark, texts, {1: ITEM, 2: None, 3: "", 4: "60 3 5 70 8 9 10 11 12"})
    assert got == {(1, 1): False, (2, 1): True, (4, 1): False, (9, 1): False}


def test_each_copy_is_judged_by_itself(spark):
    one, two = ITEM.replace("60", "75"), ITEM.replace("60", "90")
    chance = "leaves Boston at 80 miles and meets Alice after a while"
    longer = ITEM.replace("60", "75") + ", where a man sold 60 red apples and kept a dozen of them for the long winter that was to come so soon after"
    texts = {1: f"{one}. Words between them. {two}.", 2: f"{one}. Later: {chance}.", 3: one.replace("3 hours", "75 hours")}
    assert pairs(spark, texts, {1: ITEM}) == {(1, 1): True, (2, 1): True}
    assert pairs(spark, {1: longer}, {1: ITEM}) == {(1, 1): True}


def test_common_replacements(spark):
    names = "Alice has five red apples in a basket today. Bob takes two green pears from the old kitchen table there."
    sums = "The shop on the corner sells 900 loaves and New York buys 5 more of them before the night comes down"
    texts = {
        1: names.replace("Alice", "Carol").replace("Bob", "David"),
        2: names.replace("five", "sixteen").replace("two", "zero"),
        3: sums.replace("900", "1,000"),
        4: sums.replace("5", "7.5"),
        5: sums.replace("New York", "Paris"),
        6: sums.replace("New York", "Little Rock").replace("900", "ninety"),
    }
    assert pairs(spark, texts, {1: names, 2: sums}) == {(d, 1 if d < 3 else 2): True for d in texts}


def test_short_items_and_empty_tables(spark):
    assert pairs(spark, {1: "so the quick brown fox jumps"}, {5: "The quick brown fox jumps"}) == {(1, 5): False}
    assert pairs(spark, {1: "the quick"}, {5: "the quick"}) == {}
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, bench).count() == 0
    assert contaminated(spark.createDataFrame([(1, ITEM)], "doc_id long, text string"), bench).count() == 0


def test_general_items_and_passages(spark):
    sums, long = "Calculate 12 + 45 - 3 * 7 / 2", " ".join(f"w{k}ord" for k in range(27))
    texts = {1: f"Task: {sums} =", 2: "so red green blue it is", 3: "before " + " ".join(long.split()[5:18]) + " after", 4: "Calculate 12 + 46 - 3 * 7 / 2"}
    texts[5] = "before " + " ".join(long.split()[5:17]) + " after"
    got = pairs(spark, texts, {1: sums, 2: "Red green blue", 3: long})
    assert got == {(1, 1): False, (2, 2): False, (3, 3): False}


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    wanted = set()
    windows = defaultdict(set)
    for i, w in items.items():
        for k in range(max(1, len(w) - 7)):
            windows[tuple(w[k : k + 8])].add((i, k))
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        w = words(r.text)
        seen = defaultdict(set)
        for k in range(len(w) - 7):
            for i, place in windows.get(tuple(w[k : k + 8]), ()):
                seen[i].add(place)
        wanted |= {(r.doc_id, i) for i, places in seen.items() if len(places) >= 0.8 * max(1, len(items[i]) - 7)}
    assert {(r.doc_id, r.item_id) for r in decontamination(spark, folder).collect()} == wanted
    assert wanted


def test_windows_and_sets_of_hashes_share_their_work():
    """Windows of several sizes go on from each other, and membership is told without a sort of all values."""
    values = np.array([words.hash_of(f"w{n % 40}") for n in range(60)], np.uint64)
    for some in (values, values[:5], values[:0]):
        made = dict(words.windows_of_sizes(some, (1, 3, 8)))
        assert list(made) == [size for size in (1, 3, 8) if size <= len(some)]
        assert all(np.array_equal(own, words.windows(some, size)) for size, own in made.items())
    members = np.append(values[3:6], values[0] ^ np.uint64(1 << 40))  # one that differs from a value in high bits alone
    lookup = words.Lookup(members)
    assert np.array_equal(lookup.holds(values), np.isin(values, members))
    assert len(lookup.holds(values[:0])) == 0
    assert lookup.table.sum() <= len(members)


def test_texts_looked_at_together():
    """Texts in a row give the windows that each gives alone: nothing goes on over the end of a text."""
    texts = [t.encode() for t in ("", "New", "York has 3", "km to go", "5", ".", "12", "", "İstanbul is far. ΟΣ", "Σ", ITEM, " \n", "Alice", "Bob sells 1,000", "")]
    may = np.ones(1 << 4, bool)

    def shown(some: list[bytes]) -> set:
        return {(int(n), int(h), int(s), w.tobytes()) for hs, ns, ss, ws in decontaminate._shown_windows(some, (1, 2, 3, 8), may, 1 << 4) for h, n, s, w in zip(hs, ns, ss, ws)}

    alone = {(n, *row[1:]) for n, text in enumerate(texts) for row in shown([text])}
    assert shown(texts) == alone
    ends = list(decontaminate._portions([b"x" * 70000, b"", b"y", b"z" * 65535, b"u"]))
    assert ends == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(decontaminate._portions([])) == []


def test_slots_are_compared_without_python(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert "BatchEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
