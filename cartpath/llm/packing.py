"""Packing of tokenised documents into sequences by the sum-of-squares rule.

A bin is a sequence that still has room; what matters of it is the room alone, so the state is one
count per possible gap. A piece goes where the sum of the squared counts becomes smallest, a new bin
included, which keeps all gaps about equally rare and the packing close to full. Groups of pieces are
packed independently; each is large enough that its last open bins weigh little.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpath.llm.common import body, durable, rows_of

END = 1
# The tokenizer's own rule of what a word is, and the texts for which chunks between blanks can be
# encoded one by one: no letters beyond the Latin ones, no rare blanks, no text of a special token.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
# Byte-level vocabularies name a byte by its own character if that is visible, and else by one from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(sorted(set(range(256)).difference(_VISIBLE)))}
_MOST_CHUNKS, _MOST_WORDS = 800_000, 400_000


class Encoder:
    """Token ids of texts. Ids of chunks between blanks are remembered, up to a fixed number of them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, chunks: list[str]) -> None:
        if len(self.words) > _MOST_WORDS:
            self.words.clear()
        words, tokenize = self.words, self.model.tokenize
        # Letters alone are one word.
        cut = [[chunk] if chunk.isalpha() else _PRETOKEN.findall(chunk) for chunk in chunks]
        for word in {word for some in cut for word in some if word not in words}:
            # Normalised and cut already: only the model is left to ask, in its alphabet of bytes. That has visible ASCII as it is.
            spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
            words[word] = [t.id for t in tokenize(spelt)]
        flat: list[int] = []
        ends = []
        for some in cut:
            for word in some:
                flat += words[word]
            ends.append(len(flat))
        at, new = len(self.known), len(chunks)
        while at + new > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(flat)] = flat
        sizes = np.diff(ends, prepend=0)
        self.sizes[at : at + new], self.starts[at : at + new] = sizes, self.used + np.array(ends) - sizes
        self.used += len(flat)
        self.known.update(zip(chunks, range(at, at + new), strict=True))

    def all_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Chunks are cut and told apart in Arrow, so each different one is looked up once."""
        usual = ["<|" not in text and _UNUSUAL.search(text) is None for text in texts]
        lowered = [text.lower() if plain else "" for text, plain in zip(texts, usual, strict=True)]
        chunks = pc.ascii_split_whitespace(pa.array(lowered, pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > _MOST_CHUNKS:
            self.forget()
        at = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            absent = [distinct[i] for i in missing]
            self._learn(absent)
            at[missing] = [self.known[chunk] for chunk in absent]
        at = at[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.starts[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        cuts = ends[chunks.offsets.to_numpy()]
        return [
            flat[cuts[i] : cuts[i + 1]] if plain else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            for i, (text, plain) in enumerate(zip(texts, usual, strict=True))
        ]

    def ids(self, text: str) -> np.ndarray:
        return self.all_ids([text])[0]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Token pieces of each row: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and the end id; only one longer than ``capacity`` is cut. A null or empty text
    is the end id alone. Rows with a null or repeated doc_id are documents of their own.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        for rows in rows_of(parts, 256):
            out: list[tuple] = []
            texts = [text.decode("utf-8", "replace") for text in rows.column(1).to_pylist()]
            for doc_id, found in zip(rows.column(0).to_pylist(), encoder.all_ids(texts), strict=True):
                ids = np.append(found, np.uint32(END)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    out.append((doc_id, number, start, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32) if keep_ids else None))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            count = 6 if keep_ids else 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns[:count], kinds[:count], strict=True)], names=list("abcdef")[:count]
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), body().alias("text")).mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, in the given order, and the number of bins."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by gap
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # Change of the sum if a gap g becomes g - size; a gap of 0 is a closed bin and is not counted.
        gain = 2 * (count[: capacity - size + 1] - count[size:]) + 2
        gain[0] -= 2 * count[0] + 1
        gain[count[size:] == 0] = np.iinfo(np.int64).max
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        best = int(gain.argmin())
        if gain[best] <= fresh:
            gap = best + size
            number = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, number = capacity, made
            made += 1
        bins[i], offsets[i] = number, capacity - gap
        if gap > size:
            open_bins[gap - size].append(number)
            count[gap - size] += 1
    return bins, offsets, made


def pack(cut: DataFrame, capacity: int = 4096, group_pieces: int = 65_536) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    A piece of full length is a sequence of its own. The others are dealt evenly over groups of about
    ``group_pieces`` and packed there, in random and in falling order, of which the one with fewer
    sequences counts. An empty table stays empty.
    """
    fixed = durable(cut).withColumn("_n", F.monotonically_increasing_id())
    partial = fixed.where(F.col("length") < capacity)
    groups = max(1, math.ceil(partial.count() / group_pieces))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy()
        mixed = np.lexsort((group["_n"].to_numpy(), group["_mix"].to_numpy()))
        falling = mixed[np.argsort(-lengths[mixed], kind="stable")]
        order, (bins, offsets, _) = min(
            ((o, sum_of_squares(lengths[o], capacity)) for o in (mixed, falling)), key=lambda tried: tried[1][2]
        )
        number = (int(group["_group"].iloc[0]) << 32) + bins
        return pd.DataFrame({"_n": group["_n"].to_numpy()[order], "sequence_id": number, "offset": offsets})

    dealt = partial.select("_n", "length", F.xxhash64("_n").alias("_mix")).withColumn("_group", F.pmod("_mix", F.lit(groups)))
    placed = dealt.groupBy("_group").applyInPandas(place, "_n long, sequence_id long, offset long")
    whole = fixed.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("_n"), "offset": F.lit(0).cast("long")})
    return partial.join(placed, "_n").unionByName(whole).drop("_n")
