from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq

from cartpath.llm import near_dup, words
from tests.llm.brute import classes, shingles


def found(docs, **options):
    return {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs, **options).collect()}


def test_register_agreement_is_probability_jaccard():
    rng = np.random.default_rng(2)
    ids = words.mix(np.arange(1, 61, dtype=np.uint64))
    a = np.concatenate([rng.uniform(0.5, 5, 40), np.zeros(20)])
    b = np.concatenate([np.zeros(15), rng.uniform(0.5, 5, 45)])
    b[15:40] = a[15:40] * rng.uniform(0.8, 1.2, 25)
    p, q = a / a.sum(), b / b.sum()
    both = np.flatnonzero((p > 0) & (q > 0))
    exact = sum(1 / np.maximum(p / p[i], q / q[i]).sum() for i in both)
    owner = np.concatenate([np.zeros(40, np.int64), np.ones(45, np.int64)])
    marks = near_dup.signatures(np.concatenate([ids[:40], ids[15:]]), np.concatenate([a[:40], b[15:]]), owner, 2, 4096)
    assert abs((marks[0] == marks[1]).mean() - exact) < 0.04


def test_edge_rows_and_groups(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}é" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = [(None, "x y z"), (1, None), (2, ""), (3, " .,!"), (4, "one"), (5, "One!"), (6, "one two")]
    rows += [(10 + i, " ".join(base)) for i in range(30)] + [(50, " ".join(base).upper() + " !!"), (51, "one two"), (51, "one two")]
    for i in range(60):
        edited = list(base)
        for _ in range(rng.randint(0, 4)):
            edited[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(edited)))
    for i in range(30):
        rows.append((200 + i, " ".join(rng.choice(vocabulary) for _ in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(docs) == classes(rows, 5, 0.8)


def test_links_within_large_buckets_of_unlike_texts(spark):
    """Texts that share most words, but are linked in pairs only: no centre of a bucket helps the others."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(150)]
    ids = rng.sample(range(10_000), 240)
    rows = []
    for i in range(120):
        own = [f"t{i}x{k}" for k in range(50)]
        edited = [*own[:20], "new", *own[21:]]
        rows += [(ids[2 * i], " ".join(common + own)), (ids[2 * i + 1], " ".join(common + edited))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = classes(rows, 5, 0.8)
    assert len(set(expected.values())) == 120
    assert found(docs) == expected


def test_many_edits_of_one_template(spark):
    """Texts of one template that are unlike but for some pairs, so buckets are large at any number of bands."""
    rng = random.Random(12)
    template = [f"c{i}" for i in range(300)]
    texts = []
    for i in range(150):
        places = rng.sample(range(2, 300, 5), 8)
        for one, own in (("a", places[2:5]), ("b", places[5:])):
            edited = list(template)
            for k in places[:2]:
                edited[k] = f"e{i}x{k}"
            for k in own:
                edited[k] = f"{one}{i}x{k}"
            texts.append(edited)
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    expected = family_classes(rows)
    assert 100 < len(set(expected.values())) <= 150
    assert found(docs) == expected


def test_copies_with_a_long_repeated_tail(spark):
    rows = []
    for i in range(12):
        own, extra = [f"t{i}x{k}" for k in range(90)], [f"r{i}x{k}" for k in range(15)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own + extra * 1000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = classes(rows, 5, 0.8)
    assert len(set(expected.values())) == 12
    assert found(docs) == expected


def family_classes(rows, size=5, least=0.8):
    """As ``brute.classes``, all pairs compared, by a product of matrices."""
    sets = [shingles(t, size) for _, t in rows]
    at = {s: k for k, s in enumerate(set().union(*sets))}
    template = [k for s, k in at.items() if sum(s in x for x in sets[:60]) > 1]
    dense = {k: c for c, k in enumerate(template)}
    common = np.zeros((len(rows), len(dense)), np.float32)
    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            if (c := dense.get(at[s])) is not None:
                common[i, c] = 1
            else:
                holders.setdefault(s, []).append(i)
    shared = common @ common.T
    for ids in holders.values():
        for i in ids:
            shared[i, ids] += 1
    sizes = np.array([len(s) for s in sets])
    like = shared >= least * (sizes[:, None] + sizes[None, :] - shared) - 1e-6
    root = np.arange(len(rows))
    while True:
        new = np.array([root[like[i]].min() for i in range(len(rows))])
        if np.array_equal(new, root):
            return {d: rows[r][0] for (d, _), r in zip(rows, root, strict=True)}
        root = new


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(folder, columns=["doc_id", "text"]).to_pylist()]
    assert found(spark.read.parquet(folder)) == classes(rows, 5, 0.8)


def test_chains_are_one_class(spark):
    nodes = spark.range(0, 40).withColumnRenamed("id", "id")
    links = spark.createDataFrame([(i + 1, i) for i in range(19)] + [(30, 39), (39, 31)], "a long, b long")
    roots = {r.id: r.root for r in near_dup.components(nodes, links).collect()}
    assert roots == {i: 0 if i < 20 else 30 if i in (30, 31, 39) else i for i in range(40)}


def test_empty_table_and_other_columns(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == {}
    docs = spark.createDataFrame([(1, "a b", 2, "z")], "doc_id long, text string, id int, bands string")
    assert found(docs) == {1: 1}


def test_texts_of_one_document_are_one_class(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, c), (8, c), (9, None), (20, ""), (20, c + " tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs) == {1: 1, 5: 1, 7: 1, 8: 8, 9: 8, 20: 8}


def test_pairs_within_a_class_are_not_made(spark):
    """Only ids of other classes become rows, each pair from one side, however many groups it meets in."""
    linked = [(n, 0, band, 10) for n in range(1, 500) for band in range(4)]
    apart = [(n, n, band, 1) for n in (900, 901) for band in range(4)]
    few = [(n, n, 7, 1) for n in range(950, 955)]
    rows = spark.createDataFrame([(i, root, band, 0, common) for i, root, band, common in linked + apart + few], "id long, root long, band int, bucket long, common long")
    pairs = near_dup._unlinked_pairs(rows, ["band", "bucket"], 0)
    found = {(r.a, r.b) for r in pairs.collect()}
    assert {(a, b) for a, b in found if a >= 950} == {(a, b) for a in range(950, 955) for b in range(a + 1, 955)}
    # The outsiders meet the row that has most in common with others.
    assert {b for a, b in found if a < 500} >= {900, 901} and all(b >= 900 for _, b in found)
    made = []

    def look(node) -> None:
        if node.nodeName().startswith("Adaptive"):
            look(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            look(node.plan())
        elif node.nodeName() == "Generate" and "other" in node.output().mkString():
            made.append(node.metrics().get("numOutputRows").get().value())
        for k in range(node.children().size()):
            look(node.children().apply(k))

    look(pairs._jdf.queryExecution().executedPlan())
    assert made and sum(made) <= 2 * len(found) + 8
