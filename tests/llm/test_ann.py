from __future__ import annotations

import numpy as np

from cartpath.llm import ann


def brute(vectors: dict[int, np.ndarray], every: int, k: int) -> dict[int, list[tuple[int, float]]]:
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids.tolist()])
    out = {}
    for q in ids[ids % every == 0].tolist():
        score = (matrix * vectors[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)).tolist() if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in table.collect()}
    exact = brute(vectors, 20, 20)
    found: dict[int, list] = {}
    for r in ann.search(table).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
        assert abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12
    assert found.keys() == exact.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hits / sum(map(len, exact.values())) >= 0.9


def test_edge_rows_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(50)]
    bad = [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0.0, 0.0, 1.0]), (205, [float("inf"), 0.0, 0.0, 1.0])]
    bad += [(None, [1.0] * 4), (220, [1.0] * 5), (100, [1.0, 2.0, 3.0, 4.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").repartition(4)
    got: dict[int, list] = {}
    # One part: the search is exact, over several blocks.
    for r in ann.search(table, parts=1, block_rows=25).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    wanted = brute({i: np.array(v) for i, v in rows}, 20, 20)
    assert got == {q: [(i, round(s, 9)) for i, s in near] for q, near in wanted.items()}


def test_balanced_parts():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 4
    vectors = centres[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16))
    graph = ann.neighbours(vectors, 10)
    part = ann.balanced_parts(graph, vectors, 8, rng)
    assert np.bincount(part, minlength=8).max() <= 111
    assert (part[graph] == part[:, None]).mean() > 0.5


def test_empty_table(spark):
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3 if i % 3 else 5).tolist()) for i in range(120)] + [(2000, [1.0])]
    table = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "vec_id long, embedding array<double>, v string, score double")
    expected = {}
    for length in (3, 5):
        vectors = {i: np.array(v) for i, v in rows if len(v) == length}
        expected |= brute(vectors, 20, 20)
    got: dict[int, list] = {}
    for r in ann.search(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in found] for q, found in expected.items()}
    assert set(got) == set(range(0, 120, 20))
