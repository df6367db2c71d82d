"""Removal of long byte strings that occur more than once anywhere in the corpus.

Anchors bring equal strings together without sorting the whole corpus in one place: the anchor of a
window of ``length`` bytes is its smallest hash of ``gram`` bytes, which equal windows share. Successive
windows of one anchor form a snippet. Equal snippets are counted; snippets that share an anchor but
differ go to one shard, where induced sorting of their suffixes finds the windows they have in common.
Where an anchor has more different snippets than a shard should hold, its windows get anchors of
their own, a hash of all their bytes, and are dealt anew by them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpath.llm import induced_sort, words
from cartpath.llm.common import body, durable, release, rows_of, written

_MOST_STARTS = 2_000  # a longer run of windows of one anchor, as in periodic texts, is cut into several snippets
_RANGES = 8  # of places that an anchor may have in a window
_LOOKED = 256 << 10  # bytes of snippets that are looked at together before they are sorted
KEY = ["anchor", "content"]
# What tells a row: its id and a hash of its text. Rows that agree in both have the same marks.
ROW = ["doc", "crc"]


class _Rolling:
    """Hashes of substrings of one text."""

    def __init__(self, data: np.ndarray):
        self.powers, self.inverse = words._grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return words.mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` successive values, from running minima of blocks."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def snippets(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor, content hash, first window start, number of windows and ``inner`` of the snippets of a text.

    ``inner`` tells that the anchor is there twice, so windows of one snippet may equal each other.
    """
    if len(text) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none.astype(bool)
    rolling = _Rolling(np.frombuffer(text, np.uint8))
    grams, width = rolling.all(gram), length - gram + 1
    least = _sliding_least(grams, width)
    edges = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    sizes = np.diff(np.append(edges, len(least)))
    # A gram is an anchor if it is the least of some window around it.
    padded = np.full(len(grams) + width - 1, np.iinfo(np.uint64).max, np.uint64)
    padded[width - 1 : width - 1 + len(least)] = ~least
    anchors = np.flatnonzero(~_sliding_least(padded, width) == grams)
    inner = np.zeros(len(edges), bool)
    near = np.flatnonzero(grams[anchors[1:]] == grams[anchors[:-1]])
    if len(near):
        one, two = anchors[near], anchors[near + 1]
        last = len(least) - 1
        low = np.searchsorted(edges, np.clip(two - width + 1, 0, last), side="right") - 1
        high = np.searchsorted(edges, np.clip(one, 0, last), side="right") - 1
        for value, a, b in zip(grams[one], np.minimum(low, high), np.maximum(low, high), strict=True):
            inner[a : b + 1] |= least[edges[a : b + 1]] == value
    if sizes.max() > _MOST_STARTS:
        parts = -(-sizes // _MOST_STARTS)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        stop = np.repeat(edges + sizes, parts)
        edges, inner = np.repeat(edges, parts) + step * _MOST_STARTS, np.repeat(inner, parts)
        sizes = np.minimum(stop - edges, _MOST_STARTS)
    return least[edges], rolling.of(edges, edges + sizes + length - 1), edges, sizes, inner


def _cut(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts):
            found = [snippets(t, length, gram) for t in rows.column(2).to_pylist()]
            owner = pa.array(np.repeat(np.arange(rows.num_rows), [len(f[0]) for f in found]))
            anchor, content, start, count, inner = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), *(rows.column(i).take(owner) for i in (0, 1)), *map(pa.array, (start.astype(np.int32), count.astype(np.int32), inner))],
                names=[*KEY, *ROW, "start", "windows", "inner"],
            )

    return docs.select(*ROW, "text").mapInArrow(cut, "anchor long, content long, doc long, crc long, start int, windows int, inner boolean")


def _bytes_of(wanted: DataFrame, docs: DataFrame, length: int, split: bool) -> DataFrame:
    """Bytes of the wanted snippets (doc, crc, start, windows, anchor, content); with ``split`` the hash of each window instead."""
    lists = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("start", "windows", "anchor", "content")).alias("wanted"))
    joined = docs.join(lists, ROW).select("text", "wanted")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(parts, 64):
            out: list[tuple] = []
            for text, some in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                for w in some:
                    a, n = w["start"], w["windows"]
                    if split:
                        for k in range(n):
                            digest = np.frombuffer(hashlib.md5(text[a + k : a + k + length]).digest(), np.int64)
                            out.append((w["anchor"], w["content"], k, int(digest[0]), int(digest[1])))
                    else:
                        out.append((w["anchor"], w["content"], text[a : a + n + length - 1]))
            columns = list(zip(*out, strict=True)) or [[]] * (5 if split else 3)
            kinds = [pa.int64(), pa.int64(), *([pa.int32(), pa.int64(), pa.int64()] if split else [pa.binary()])]
            names = [*KEY, *(["at", "w1", "w2"] if split else ["bytes"])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return joined.mapInArrow(cut, "anchor long, content long, " + ("at int, w1 long, w2 long" if split else "bytes binary"))


def _runs(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of successive places of one owner: owner, first place, count."""
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(owner)), bool), (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)]))
    return owner[new], place[new], np.diff(np.append(new, len(owner)))


def meeting(anchors: np.ndarray, strings: list[bytes], length: int, gram: int) -> np.ndarray:
    """Which snippets, given by anchor and bytes, may have a window that is there twice; no other needs to be sorted.

    A window that is there twice has its anchor at one place in both, so what lies around the anchors is
    equal. For each range of places of the anchor in the window, those bytes are hashed that every such
    window has; a snippet of which no hash is there twice has no repeated window.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    rolling = _Rolling(np.frombuffer(b"".join(strings), np.uint8))
    at = np.flatnonzero(rolling.all(gram) == np.repeat(anchors, sizes)[: stops[-1] - gram + 1])
    owner = np.searchsorted(stops, at, side="right")
    inside = at + gram <= stops[owner]
    at, owner = at[inside], owner[inside]
    may = np.zeros(len(strings), bool)
    most = length - gram  # bytes of a window besides its anchor
    step = max(1, most // _RANGES)
    for before in range(0, most + 1, step):
        low, high = at - before, at + gram + max(0, most - before - step + 1)
        fits = np.flatnonzero((low >= starts[owner]) & (high <= stops[owner]))
        _, which, count = np.unique(rolling.of(low[fits], high[fits]), return_inverse=True, return_counts=True)
        may[owner[fits[count[which] > 1]]] = True
    return may


def _compared(strings: DataFrame, length: int, gram: int, shard_bytes: int, memory: int) -> DataFrame:
    """Runs of windows that snippets of one anchor share: anchor, content, first, count."""

    def sort(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, contents, held, size = [], [], [], 0
        looked, weight = 0, 0  # how many of them have been looked at, and the bytes of the others

        def look() -> None:
            """Keep those that may have a repeated window. Rows come sorted by anchor, and all of an anchor are looked at together."""
            nonlocal looked, size, weight
            some = slice(looked, None)
            if held[some]:
                may = meeting(np.array(anchors[some], np.int64).view(np.uint64), held[some], length, gram).tolist()
                for column in (anchors, contents, held):
                    column[some] = compress(column[some], may)
                size += sum(map(len, held[some]))
            looked, weight = len(held), 0

        def found() -> pa.RecordBatch:
            owner, first, count = _runs(*induced_sort.repeated(held, length, memory))
            at = pa.array(owner)
            return pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()).take(at), pa.array(contents, pa.int64()).take(at), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
                names=[*KEY, "first", "count"],
            )

        last = None
        for part in parts:
            for anchor, content, string in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if weight >= _LOOKED and anchor != last:  # no anchor is torn apart
                    look()
                if size >= shard_bytes and not weight:
                    yield found()
                    anchors, contents, held, size, looked = [], [], [], 0, 0
                last = anchor
                anchors.append(anchor)
                contents.append(content)
                held.append(string)
                weight += len(string)
        look()
        if held:
            yield found()

    dealt = strings.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(sort, "anchor long, content long, first int, count int")


def dedup_substrings(
    docs: DataFrame, length: int = 200, gram: int = 40, hot_anchor: int = 2_000, shard_bytes: int = 2 << 20, memory: int = 64 << 20
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and text (bytes) of each row after removal.

    Each byte is removed that a string of ``length`` bytes covers which starts at two places or more, in
    one text or in several. Texts are their UTF-8 bytes, null and empty ones have none. Rows are texts of
    their own, whether or not their doc_id is null or repeated. An empty table gives an empty table.

    ``shard_bytes`` is what is sorted at once and ``memory`` what its queues hold before they spill; an
    anchor with more than ``hot_anchor`` different snippets is dealt again by whole windows.
    """
    given = docs.select(F.col("doc_id").cast("long"), body().alias("text"))
    numbered = given.withColumns({"doc": F.coalesce("doc_id", F.lit(0)), "crc": F.xxhash64("text")})
    places = written(_cut(numbered, length, gram), "anchors")
    summed = places.groupBy(*KEY).agg(F.count("*").alias("copies"), F.bool_or("inner").alias("inner"), F.min(F.struct(*ROW, "start", "windows")).alias("sample"))
    kinds = written(summed, "snippets")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.bool_or("inner").alias("any_inner")).where("kinds > 1 OR any_inner")
    # A snippet that occurs twice is repeated as a whole; it still takes part for the others' sake.
    shared = durable(kinds.join(several, "anchor").select(*KEY, "copies", "sample", "kinds"))
    once = shared.select(*KEY, "sample.*", "kinds")
    # Each step is written by itself, so that no more than one of them has its exchanged texts on disk.
    plain = written(_compared(_bytes_of(once.where(F.col("kinds") <= hot_anchor), numbered, length, False), length, gram, shard_bytes, memory), "repeats")

    parts, used = plain, [places, kinds, plain]
    if once.where(F.col("kinds") > hot_anchor).limit(1).count():
        hot = written(_bytes_of(once.where(F.col("kinds") > hot_anchor), numbered, length, True), "windows")
        twice = hot.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
        again = hot.join(durable(twice), ["w1", "w2"], "left_semi")  # one row of a window at most
        used.append(hot)
        parts = parts.unionByName(again.select(*KEY, F.col("at").alias("first"), F.lit(1).alias("count")))

    copied = kinds.where("copies > 1").select(*KEY, F.lit(0).alias("first"), F.col("sample.windows").alias("count"))
    spans = parts.unionByName(copied).groupBy(*KEY).agg(F.collect_set(F.struct("first", "count")).alias("parts"))
    marks = places.join(spans, KEY).select(*ROW, "start", "parts")
    lists = written(marks.groupBy(*ROW).agg(F.collect_set(F.struct("start", "parts")).alias("marks")), "marks")
    release(*used)
    joined = numbered.join(lists, ROW, "left").select("doc_id", "text", "marks")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, 128):
            sizes, removed, runs, left = [], [], [], []
            for text, marked in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                change = np.zeros(len(text) + 1, np.int32)
                for mark in marked or ():
                    for part in mark["parts"]:
                        a = mark["start"] + part["first"]
                        change[a] += 1
                        change[a + part["count"] + length - 1] -= 1
                gone = np.cumsum(change)[:-1] > 0
                sizes.append(len(text))
                removed.append(int(gone.sum()))
                runs.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                left.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if removed[-1] else text)
            arrays = [rows.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "text"])

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, text binary")
