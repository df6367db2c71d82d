from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cartpath.llm import packing
from cartpath.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_encoder_is_exact(tokenizer):
    rng = random.Random(1)
    encoder = packing.Encoder(tokenizer_path())
    texts = ["", " ", "<|endoftext|> a", "don't I'LL 'sS", "İstanbul ß Σας", "x" * 3000, "a\x1cb c", "日本 é"]
    for i in range(400):
        pool = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0xA1, 0x250), lambda: 32, lambda: rng.randrange(97, 123)]
        pool += [lambda: rng.randrange(0, 0x3000)] * (i % 3 == 0)
        texts.append("".join(chr(rng.choice(pool)()) for _ in range(rng.randint(0, 60))))
    for text in texts:
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_and_sequences(spark, tokenizer):
    rng = random.Random(2)
    rows = [(None, None), (1, None), (2, ""), (3, "word " * 400), (3, "word " * 400), (None, "a b c")]
    rows += [(10 + i, " ".join(rng.choice(["alpha", "beta.", "gamma,", "Ünï"]) for _ in range(rng.randint(1, 200)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = packing.pack(packing.pieces(docs, tokenizer_path(), capacity=100), capacity=100, group_pieces=60).collect()
    wanted = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, start in enumerate(range(0, len(ids), 100)):
            part = ids[start : start + 100]
            wanted.append((doc_id, n, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(wanted, key=key)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 100
    assert len(sequences) <= 1.1 * sum(r.length for r in got) / 100 + 4


def test_rule_takes_the_smallest_sum_of_squares():
    lengths = np.random.default_rng(3).integers(1, 30, 200)
    bins, offsets, made = packing.sum_of_squares(lengths, 30)
    room, counts = {}, defaultdict(int)
    for size, number, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        tried = {}
        for gap in [*{g for g in room.values() if g >= size}, None]:
            after = dict(counts)
            if gap is not None:
                after[gap] -= 1
            rest = (30 if gap is None else gap) - size
            if rest:
                after[rest] = after.get(rest, 0) + 1
            tried[gap] = sum(v * v for v in after.values())
        gap = room.get(number)
        assert tried[gap] == min(tried.values())
        assert offset == 30 - (30 if gap is None else gap)
        if gap is not None:
            counts[gap] -= 1
        room[number] = (30 if gap is None else gap) - size
        if room[number]:
            counts[room[number]] += 1
        else:
            del room[number]
    assert made == len(set(bins.tolist()))


def test_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "one two", 3)], "doc_id long, text string, offset int")
    row = packing.pieces(docs, tokenizer_path(), keep_ids=True).first()
    assert len(row.ids) == row.length == 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces(empty, tokenizer_path())).count() == 0


def test_letters_alone_are_one_word(tokenizer, monkeypatch):
    """Chunks of letters are not given to the pattern, which would find nothing but the chunk."""
    letters = [chr(c) for c in range(0x250) if not packing._UNUSUAL.search(chr(c))]
    assert all(packing._PRETOKEN.findall(c) == [c] and packing._PRETOKEN.findall(f"z{c}") == [f"z{c}"] for c in letters if c.isalpha())
    monkeypatch.setattr(packing, "_PRETOKEN", None)
    text = "plain words of Größe and ŁÓDŹ and " + "".join(c for c in letters if c.lower() == c and c.isalpha())
    assert packing.Encoder(tokenizer_path()).ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
