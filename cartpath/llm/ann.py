"""Nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts with few neighbours apart. A small
network learns to tell the part from the vector. It then gives every row its part, and every query the
parts that most probably hold its neighbours; the rows of these are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpath.llm.common import durable, rows_of


@dataclass
class Router:
    """Two layers; ``probes`` is the number of parts a query asks."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    probes: int

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return np.maximum(vectors @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias


def neighbours(vectors: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """The ``k`` rows of largest inner product to each row, itself left out."""
    found = np.zeros((len(vectors), k), np.int64)
    for start in range(0, len(vectors), block):
        near = vectors[start : start + block] @ vectors.T
        near[np.arange(len(near)), start + np.arange(len(near))] = -np.inf
        found[start : start + block] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return found


def balanced_parts(graph: np.ndarray, vectors: np.ndarray, parts: int, rng: np.random.Generator, slack: float = 1.1, rounds: int = 30) -> np.ndarray:
    """A part for each node, none over ``slack`` times the mean, with most edges inside.

    Nodes start in chunks of their order along the main direction; then in each round those that gain
    most move to the part that holds most of their neighbours, while there is room.
    """
    n = len(graph)
    room = int(np.ceil(slack * n / parts))
    centred = vectors - vectors.mean(axis=0)
    centres = centred[rng.choice(n, parts, replace=False)]
    fit = centred @ centres.T
    part = np.full(n, -1)
    sizes = np.zeros(parts, np.int64)
    for node in np.argsort(-fit.max(axis=1)):
        best = int(np.where(sizes < room, fit[node], -np.inf).argmax())
        part[node] = best
        sizes[best] += 1
    both = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)])
    other = np.concatenate([graph.reshape(-1), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):
        held = np.zeros((n, parts))
        np.add.at(held, (both, part[other]), 1)
        own = held[np.arange(n), part]
        wish = held.argmax(axis=1)
        gain = held[np.arange(n), wish] - own
        moved = 0
        for node in np.argsort(-gain)[: int((gain > 0).sum())]:
            if sizes[wish[node]] < room and rng.random() < 0.7:
                sizes[part[node]] -= 1
                sizes[wish[node]] += 1
                part[node] = wish[node]
                moved += 1
        if not moved:
            break
    return part


def fit(sample: np.ndarray, parts: int, k: int, goal: float, width: int = 128, epochs: int = 40, seed: int = 11) -> Router:
    """Learn the parts of a sample, and the fewest probes with which its vectors find ``goal`` of their neighbours in it."""
    rng = np.random.default_rng(seed)
    n, dims = sample.shape
    parts = int(max(1, min(parts, n // (4 * k))))
    if parts == 1:
        return Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = neighbours(sample, k)
    part = balanced_parts(graph, sample, parts, rng)
    # What the network shall tell is where a vector's neighbours are, itself included.
    goal_share = np.zeros((n, parts))
    np.add.at(goal_share, (np.arange(n), part), k / 2)
    np.add.at(goal_share, (np.repeat(np.arange(n), k), part[graph.reshape(-1)]), 1)
    goal_share /= goal_share.sum(axis=1, keepdims=True)
    scale = 1 / max(float(np.linalg.norm(sample, axis=1).mean()), 1e-12)
    w = [rng.normal(0, 1, (dims, width)), np.zeros(width), rng.normal(0, (2 / width) ** 0.5, (width, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(n), max(1, n // 256)):
            step += 1
            x = sample[at] * scale
            inner = np.maximum(x @ w[0] + w[1], 0)
            logits = inner @ w[2] + w[3]
            told = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (told / told.sum(axis=1, keepdims=True) - goal_share[at]) / len(at)
            back = (error @ w[2].T) * (inner > 0)
            for i, g in enumerate((x.T @ back, back.sum(axis=0), inner.T @ error, error.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                w[i] = w[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    router = Router(w[0] * scale, w[1], w[2], w[3], parts)
    order = np.argsort(-router.scores(sample), axis=1)
    rank = np.zeros_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(parts), order.shape), axis=1)
    # The place of each neighbour's part in the order in which a query asks.
    asked = np.take_along_axis(rank, order[:, 0][graph], axis=1)
    shares = np.cumsum(np.bincount(asked.reshape(-1), minlength=parts)) / asked.size
    router.probes = int(min(parts, np.searchsorted(shares, goal) + 1))
    return router


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def search(
    vectors: DataFrame, query_every: int = 20, k: int = 20, parts: int = 16, sample_rows: int = 8_192, goal: float = 0.97, block_rows: int = 16_384
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows found for each query.

    Queries are the rows whose vec_id is divisible by ``query_every``; candidates are all rows but the
    query's own id. Nearness is the inner product in double precision, ties go to the smaller vec_id.
    The model learns from at most ``sample_rows`` rows, those with the smallest hash of their id, and its
    number of probes from the recall ``goal`` on them; every row is indexed. Rows with a null vec_id, and
    vectors that are null, zero, not finite or hold nulls, take no part. Vectors have an inner product
    with those of their own length only, so each length is a search of its own. Of rows with one
    vec_id the smallest vector counts. Parts are compared in blocks of about ``block_rows`` rows and a
    fifth as many queries, so equal vectors fill no task.
    """
    spark = vectors.sparkSession
    values = F.col("embedding").cast("array<double>")
    clean = vectors.select(F.col("vec_id").cast("long"), values.alias("v")).where(
        "vec_id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    )
    lengths = sorted(r[0] for r in clean.select(F.size("v")).distinct().collect())  # one for each model that made vectors
    clean = clean.groupBy("vec_id").agg(F.min("v").alias("v"))
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dims in lengths:
        found = found.unionByName(_search(clean.where(F.size("v") == dims), dims, query_every, k, parts, sample_rows, goal, block_rows))
    return found


def _search(clean: DataFrame, dims: int, query_every: int, k: int, parts: int, sample_rows: int, goal: float, block_rows: int) -> DataFrame:
    """``search`` over vectors (vec_id, v) that all have ``dims`` numbers."""
    spark = clean.sparkSession
    taken = [r.v for r in clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()]  # bounded by sample_rows
    if not taken:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = spark.sparkContext.broadcast(fit(np.array(taken), parts, k, goal))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, 4096):
            if rows.num_rows:
                order = np.argsort(-model.value.scores(_matrix(rows.column(1), dims)), axis=1, kind="stable")[:, : model.value.probes]
                asked = pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, asked], names=["vec_id", "v", "asked"])

    index = durable(clean.mapInArrow(route, "vec_id long, v array<double>, asked array<int>"))
    rows = index.select("vec_id", "v", F.col("asked")[0].alias("part"))
    queries = index.where(F.col("vec_id") % query_every == 0).select("vec_id", "v", F.explode("asked").alias("part"))
    # At most as many rows as parts reach the driver.
    sizes = dict(rows.groupBy("part").count().collect())
    asked = dict(queries.groupBy("part").count().collect())

    def blocks(counts: dict, size: int):
        cuts = {p: -(-n // size) for p, n in counts.items()}
        return F.coalesce(F.element_at(F.map_from_arrays(F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts.values()))), F.col("part")), F.lit(1)) if cuts else F.lit(1)

    row_blocks, query_blocks = blocks(sizes, block_rows), blocks(asked, max(1, block_rows // 5))
    one = F.pmod(F.xxhash64("vec_id"), row_blocks).alias("row_block")
    many = F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block")
    left = rows.select("part", one, many, "vec_id", "v")
    one = F.pmod(F.xxhash64("vec_id", F.lit(1)), query_blocks).alias("query_block")
    many = F.explode(F.sequence(F.lit(0).cast("long"), (row_blocks - 1).cast("long"))).alias("row_block")
    right = queries.select("part", one, "vec_id", "v", many)
    left = left.withColumns({"row_block": F.col("row_block").cast("int"), "query_block": F.col("query_block").cast("int")})
    right = right.withColumns({"row_block": F.col("row_block").cast("int"), "query_block": F.col("query_block").cast("int")})

    def compare(rows: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if rows.num_rows and asking.num_rows:
            ids = rows["vec_id"].to_numpy()
            order = np.argsort(ids)
            ids, matrix = ids[order], _matrix(rows["v"], dims)[order]
            for query_id, query in zip(asking["vec_id"].to_numpy(), _matrix(asking["v"], dims), strict=True):
                # Summed in one order for each row, so equal vectors get equal scores.
                score = np.einsum("ij,j->i", matrix, query)
                score[ids == query_id] = -np.inf
                edge = np.partition(score, len(score) - k)[len(score) - k] if len(score) > k else -np.inf
                some = np.flatnonzero(score >= edge)
                some = some[np.argsort(-score[some], kind="stable")][:k]
                some = some[score[some] > -np.inf]
                out.append((np.full(len(some), query_id), ids[some], score[some]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    keys = ["part", "row_block", "query_block"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
