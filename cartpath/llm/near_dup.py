"""Near-duplicate documents by ProbMinHash.

Word shingles are weighted; every shingle sends a Poisson process of arrivals, of a rate equal to its
weight, to random registers, and a register keeps the shingle that came first. Two documents agree in a
register with the probability Jaccard similarity of their shingles. A document stops when no arrival
can still be the first of a register, so a long text costs about one arrival per shingle. Bands of
registers name candidates, and the shingles themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.llm import words
from cartpath.llm.common import body, durable, longs, release, rows_of, written

_FEW = 8  # members of a bucket that may meet each other directly
_ROUNDS = 3  # times that larger buckets meet centres before their shingles are looked at
_ORDER_BITS = 20  # slots of the counts that order shingles from rare to common
_KEPT = 4_000_000  # shingles that a task remembers between pairs
_BLOCK = 2048  # rows of one side that meet the other in one task
_BITS = 1024  # of the mask of a text's shingles
_MARK = np.uint64(0xFFFFFFFF)


def signatures(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, count: int, registers: int) -> np.ndarray:
    """(count, registers) of 32-bit shingle marks; ``owner`` tells the document of each distinct shingle."""
    state = np.full(count * registers, np.iinfo(np.uint64).max, np.uint64)
    time = np.zeros(len(shingles))
    step = 0
    while len(shingles):
        step += 1
        draw = words.mix(shingles + np.uint64(step * 0xD1342543DE82EF95 % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weights
        target = owner * registers + (words.mix(draw) % np.uint64(registers)).astype(np.int64)
        # A positive float sorts like its bits: first by arrival, then by the shingle's mark.
        value = (time.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (shingles >> np.uint64(32))
        np.minimum.at(state, target, value)
        latest = (state.reshape(count, registers) >> np.uint64(32)).astype(np.uint32).max(axis=1)
        limit = np.where(latest == 0xFFFFFFFF, np.inf, latest.view(np.float32).astype(np.float64))
        more = time <= limit[owner]
        shingles, weights, owner, time = shingles[more], weights[more], owner[more], time[more]
    return (state & _MARK).reshape(count, registers)


def weighted_shingles(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their weights, all equal: registers then agree by the Jaccard similarity that links are held to."""
    distinct = np.unique(words.windows(hashes, size))
    return distinct, np.ones(len(distinct))


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _ORDER_BITS)).astype(np.int64)


def sketches(docs: DataFrame, size: int, bands: int, rows_per_band: int) -> DataFrame:
    """doc_id, mark, a 128-bit digest of the words (null without words) and the band hashes of each row (doc_id, text, mark)."""
    registers = bands * rows_per_band

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts, 256):
            hashed = [words.word_hashes(t) for t in rows.column(1).to_pylist()]
            own = [weighted_shingles(h, size) for h in hashed]
            owner = np.repeat(np.arange(len(own)), [len(s) for s, _ in own])
            marks = signatures(np.concatenate([s for s, _ in own]), np.concatenate([w for _, w in own]), owner, len(own), registers)
            keys = np.zeros((len(own), bands), np.uint64)
            for k in range(rows_per_band):
                keys = words.mix(keys * np.uint64(31) + marks[:, k::rows_per_band] + np.uint64(1))
            keys = words.mix(keys + np.arange(bands, dtype=np.uint64))
            digests = np.zeros((len(own), 2), np.uint64)
            for i, h in enumerate(hashed):
                # Equal word sequences, and almost surely no others, have equal sums.
                places = words.mix(np.arange(1, len(h) + 1, dtype=np.uint64))
                digests[i] = (h * (places | np.uint64(1))).sum(dtype=np.uint64), words.mix(h ^ places).sum(dtype=np.uint64)
            empty = np.array([not len(h) for h in hashed], bool)
            flat = longs(keys.reshape(-1))
            offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(2),
                    pa.array(np.ascontiguousarray(digests[:, 0]).view(np.int64), mask=empty),
                    pa.array(np.ascontiguousarray(digests[:, 1]).view(np.int64), mask=empty),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["doc_id", "mark", "d1", "d2", "bands"],
            )

    return docs.mapInArrow(sketch, "doc_id long, mark long, d1 long, d2 long, bands array<long>")


def similar(pairs: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (a, b, a_text, b_text) whose sets of shingles have at least the Jaccard similarity ``least``."""

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        room = _KEPT

        def shingles(doc_id: int, text: bytes) -> np.ndarray:
            nonlocal room
            if doc_id not in known:
                own = np.unique(words.windows(words.word_hashes(text), size))
                room -= len(own)
                if room < 0:
                    known.clear()
                    room = _KEPT - len(own)
                known[doc_id] = own
            return known[doc_id]

        for rows in rows_of(parts):
            keep = []
            for a, b, a_text, b_text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                one, two = shingles(a, a_text), shingles(b, b_text)
                shared = len(np.intersect1d(one, two, assume_unique=True)) if min(len(one), len(two)) >= least * max(len(one), len(two)) else 0
                keep.append(shared >= least * (len(one) + len(two) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(mask), rows.column(1).filter(mask)], names=["a", "b"])

    return pairs.mapInArrow(verify, "a long, b long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` (id) with ``root``, the smallest id linked to it by any chain of ``links`` (a, b)."""
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = durable(both.where("id <> other").distinct())
    labels = durable(edges.groupBy("id").agg(F.least("id", F.min("other")).alias("root")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("other"), "root"), "other").groupBy("id").agg(F.min("root").alias("near"))
        stepped = labels.join(near, "id").select("id", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        # The label of the label: chains of any length halve with each round.
        jump = labels.select(F.col("id").alias("_at"), F.col("root").alias("_jump"))
        new = stepped.join(jump, stepped["root"] == jump["_at"], "left")
        new = durable(new.select("id", F.least("root", F.coalesce("_jump", "root")).alias("root"), "old"))
        moved = new.where("root <> old").limit(1).count()
        labels = new.select("id", "root")
        if not moved:
            break
    found = labels.withColumnRenamed("id", "_id")
    return nodes.join(found, nodes["id"] == found["_id"], "left").select("id", F.coalesce("root", "id").alias("root"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (id, root) after ``links`` (a, b) have connected classes; only the classes they touch are walked again."""
    a = roots.select(F.col("id").alias("a"), F.col("root").alias("a_root"))
    b = roots.select(F.col("id").alias("b"), F.col("root").alias("b_root"))
    ends = durable(links.join(a, "a").join(b, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct())
    touched = ends.select(F.col("a").alias("id")).union(ends.select("b")).distinct()
    tops = components(touched, ends).select(F.col("id").alias("root"), F.col("root").alias("top"))
    return roots.join(tops, "root", "left").select("id", F.coalesce("top", "root").alias("root"))


def _compared(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The verified ones of ``pairs`` (a, b), written once."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    met = pairs.join(b, "b").join(a, "a").select("a", "b", "a_text", "b_text")
    return written(similar(met, size, least), "links")


def _unlinked_pairs(rows: DataFrame, key: list[str], step: int) -> DataFrame:
    """Pairs (a, b) of different ``root`` in the groups of ``rows`` (id, root, common) that ``key`` makes.

    All of them in groups of up to ``_FEW`` rows; in larger ones those with three centres: the row that has
    most in common with others, and two that ``step`` draws.
    """
    own = F.struct("id", "root")
    drawn = F.xxhash64("id", *key, F.lit(step))
    groups = rows.groupBy(*key).agg(
        F.count("*").alias("held"),
        F.array(F.max_by(own, "common"), F.min_by(own, drawn), F.max_by(own, drawn)).alias("centres"),
        (F.min("root") < F.max("root")).alias("open"),
    ).where("open")
    held = rows.join(groups, key)
    listed = held.where(F.col("held") <= _FEW).groupBy(*key).agg(F.collect_list(own).alias("centres"))
    few = listed.select("centres", F.inline("centres"))
    many = held.where(F.col("held") > _FEW).select("centres", "id", "root")

    def others(once: Column) -> Column:
        """The ids of other classes; only these become rows."""
        return F.transform(F.filter("centres", lambda c: (c["root"] != F.col("root")) & (once | (c["id"] > F.col("id")))), lambda c: c["id"])

    # A group of few lists each pair from both sides, and one side is enough.
    met = few.select("id", others(F.lit(False)).alias("others")).union(many.select("id", others(F.lit(True)).alias("others")))
    # The same row meets the same centres in many groups.
    met = met.where(F.size("others") > 0).distinct().select("id", F.explode("others").alias("other"))
    return met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _prefix_pairs(rows: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Pairs (a, b) of different ``root`` of ``rows`` (id, root): at least all of the similarity ``least``.

    Shingles are put into one order for all texts, rare ones first. Two texts as similar as ``least`` have
    a shingle in common among the first of each, and from the first common one on enough must be left.
    A bit that only one mask has stands for a shingle that only one text has, so pairs whose masks differ
    in more bits than the similarity allows are left out as well.
    """
    held = written(rows.join(texts, "id").select("id", "root", "text"), "unsettled")

    def tally(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _ORDER_BITS, np.int64)
        for batch in rows_of(parts):
            for text in batch.column(0).to_pylist():
                np.add.at(counts, _slot(np.unique(words.windows(words.word_hashes(text), size))), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["slot", "n"])

    # What reaches the driver is bounded. Shingles that share a slot are ordered by their hash.
    table = held.select("text").mapInArrow(tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << _ORDER_BITS, np.int64)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(counts.tobytes())

    def prefixes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(shared.value, np.int64)
        for batch in rows_of(parts, 256):
            own = [np.unique(words.windows(words.word_hashes(t), size)) for t in batch.column(2).to_pylist()]
            first = [s[np.lexsort((s, rank[_slot(s)]))][: len(s) - int(np.ceil(least * len(s) - 1e-9)) + 1] for s in own]
            many = [len(f) for f in first]
            masks = np.zeros((len(own), _BITS), np.uint8)
            for mask, shingles in zip(masks, own, strict=True):
                mask[(shingles % np.uint64(_BITS)).astype(np.int64)] = 1
            packed = np.repeat(np.packbits(masks, axis=1).view(np.int64), many, axis=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), many)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), many)),
                    longs(np.concatenate(first)),
                    # Shingles from this one on, and all.
                    pa.array(np.concatenate([len(s) - np.arange(n) for s, n in zip(own, many, strict=True)]).astype(np.int32)),
                    pa.array(np.repeat([len(s) for s in own], many).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(packed) + 1, dtype=np.int32) * packed.shape[1]), pa.array(packed.reshape(-1))),
                ],
                names=["id", "root", "shingle", "rest", "total", "mask"],
            )

    drawn = written(held.mapInArrow(prefixes, "id long, root long, shingle long, rest int, total int, mask array<long>"), "prefixes")
    shared.destroy()
    by_root = drawn.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    # All rows of a shingle meet those outside its commonest class, in blocks of bounded size.
    groups = by_root.groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("others"))
    groups = groups.where("others > 0").select("shingle", "main", F.ceil(F.col("others") / _BLOCK).cast("int").alias("blocks"))
    open_rows = drawn.join(groups, "shingle")
    one = open_rows.where("root <> main").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).drop("blocks").alias("x")
    every = open_rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "main").alias("y")
    needed = least / (1 + least) * (F.col("x.total") + F.col("y.total")) - 1e-9
    enough = F.least("x.rest", "y.rest") >= needed
    for one_side, other in (("x", "y"), ("y", "x")):
        alone = F.zip_with(f"{one_side}.mask", f"{other}.mask", lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        enough = enough & (F.col(f"{one_side}.total") - F.aggregate(alone, F.lit(0), lambda n, bits: n + bits) >= needed)
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.block") == F.col("y.block"))
    once = (F.col("y.root") == F.col("x.main")) | (F.col("x.id") < F.col("y.id"))
    met = one.join(every, same & (F.col("x.root") != F.col("y.root")) & once & enough)
    pairs = written(met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct(), "pairs")
    release(held, drawn)
    return pairs


def near_duplicates(docs: DataFrame, size: int = 5, least: float = 0.8, bands: int = 24, rows_per_band: int = 4) -> DataFrame:
    """One row per doc_id: doc_id, copy_of (the smallest id with the same words) and class_id.

    Texts with the same words are copies; of these the smallest id stands for all. Representatives with
    the Jaccard similarity ``least`` or more of their sets of ``size``-word shingles are linked, and a
    class is what links connect; its id is the smallest in it. A text of fewer than ``size`` words is one
    shingle; one without words, null included, is a class of its own. Rows with one doc_id are one
    document, so the classes of all its texts are one class. A null doc_id is left out.

    In a bucket each member first meets the one that shares most buckets with others, which is the
    nearest to an original that copies were made from. What that has not connected is looked at again:
    buckets of up to ``_FEW`` members are compared in full, larger ones with two more centres, drawn anew
    in each of ``_ROUNDS`` rounds. Members of larger buckets that are still not of one class
    are compared by the shingles that a pair as similar as ``least`` must share, so no pair of a
    bucket is left out.
    """
    # The mark tells texts of one doc_id apart.
    source = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), body().alias("text"))
    source = source.withColumn("mark", F.xxhash64("text"))
    drawn = written(sketches(source, size, bands, rows_per_band), "sketches")
    tops = drawn.where("d1 IS NOT NULL").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("copy_of"), F.min_by("mark", "doc_id").alias("mark"), F.first("bands").alias("bands")
    )
    # Each class of copies has a number, which stays what it is once it is written.
    classes = written(tops.withColumn("id", F.monotonically_increasing_id()), "copies")

    reps = classes.select("id", F.posexplode("bands").alias("band", "bucket"))
    buckets = reps.groupBy("band", "bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(reps.join(buckets, ["band", "bucket"]), "shared")
    common = written(shared.groupBy("id").agg(F.sum("members").alias("common")), "involved")
    met = written(shared.join(common, "id"), "met")
    release(shared)
    centres = met.groupBy("band", "bucket").agg(F.max_by("id", "common").alias("centre"))
    involved = common.select("id")
    chosen = classes.select("id", F.col("copy_of").alias("doc_id"), "mark").join(involved, "id", "left_semi")
    texts = written(source.join(chosen, ["doc_id", "mark"]).dropDuplicates(["id"]).select("id", "text"), "texts")

    star = met.join(centres, ["band", "bucket"]).where("id <> centre")
    star = star.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    tried = [written(star, "pairs")]
    links = _compared(tried[0], texts, size, least)
    roots = durable(components(involved, links))
    release(links, common)

    def look(pairs: DataFrame) -> bool:
        """Compare pairs that have not met, and merge the classes that they connect."""
        nonlocal roots
        tried.append(written(pairs.join(reduce(DataFrame.union, tried), ["a", "b"], "left_anti"), "pairs"))
        found = _compared(tried[-1], texts, size, least)
        any_found = not found.isEmpty()
        if any_found:
            roots = durable(_merged(roots, found))
        release(found)
        return any_found

    def unsettled(more_than: int) -> DataFrame:
        """The members of larger buckets that are not of one class."""
        rows = met.where(F.col("members") > more_than).select("id", "band", "bucket", "common").join(roots, "id")
        parts = rows.groupBy("band", "bucket").agg((F.min("root") < F.max("root")).alias("open")).where("open")
        return written(rows.join(parts.select("band", "bucket"), ["band", "bucket"], "left_semi"), "unsettled")

    for step in range(_ROUNDS):
        rows = unsettled(_FEW if step else 2)
        done = rows.isEmpty() or not look(_unlinked_pairs(rows, ["band", "bucket"], step)) and step
        release(rows)
        if done:
            break
    rows = unsettled(_FEW)
    if not rows.isEmpty():
        pairs = _prefix_pairs(rows.select("id", "root").distinct(), texts, size, least)
        look(pairs)
        release(pairs)
    release(rows, texts, met, *tried)

    rooted = classes.join(roots, "id", "left").select("d1", "d2", "copy_of", F.coalesce("root", "id").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("copy_of").alias("class_id")), "root").drop("root")
    # Copies without words have no class above.
    out = drawn.select("doc_id", "d1", "d2").join(named, ["d1", "d2"], "left")
    out = out.select("doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"), F.coalesce("class_id", "doc_id").alias("class_id"))
    out = out.groupBy("doc_id").agg(
        F.min("copy_of").alias("copy_of"), F.min("class_id").alias("class_id"), F.collect_set("class_id").alias("_all")
    )
    out = written(out, "classes")
    release(drawn, classes)
    return _united(out)


def _united(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, copy_of, class_id, _all) with the classes that texts of one document are in made one."""
    shared = rows.where(F.size("_all") > 1).select(F.col("class_id").alias("a"), F.explode("_all").alias("b")).where("a <> b").distinct()
    shared = written(shared, "shared")
    if shared.isEmpty():
        return rows.drop("_all")
    touched = shared.select(F.col("a").alias("id")).union(shared.select("b")).distinct()
    tops = components(touched, shared).select(F.col("id").alias("class_id"), F.col("root").alias("_top"))
    return rows.join(tops, "class_id", "left").select("doc_id", "copy_of", F.coalesce("_top", "class_id").alias("class_id"))
