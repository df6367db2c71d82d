"""Words of a text as 64-bit hashes, found with array operations instead of a loop over words.

A word is a maximal run of letters, digits and underscores, lower-cased. Characters outside ASCII
count as letters where Unicode says so; the others are blanked before the bytes are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_BYTE = np.array([bool(re.match(rb"[A-Za-z0-9_\x80-\xff]", bytes([b]))) for b in range(256)])
_DIGIT_BYTE = np.array([48 <= b <= 57 for b in range(256)])
_NO_LETTER = re.compile(r"[^\w\x00-\x7f]")
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, at least ``n`` of them."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letters_only(text: bytes) -> str:
    """The text with everything beyond ASCII that is no letter or digit blanked."""
    decoded = text.decode("utf-8", "replace")
    return decoded if decoded.isascii() else _NO_LETTER.sub(" ", decoded)


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums of the bytes, from which :func:`hashes_of` takes the hash of any span."""
    powers, _ = _grown(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=running[1:])
    return running


def hashes_of(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span of the bytes that ``running`` are the :func:`sums` of."""
    _, inverse = _grown(len(running))
    return mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span of the bytes."""
    return hashes_of(sums(data), starts, ends)


def only_digits(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which spans hold digits alone."""
    running = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_DIGIT_BYTE[data], out=running[1:])
    return running[ends] - running[starts] == ends - starts


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words in order."""
    data = np.frombuffer(letters_only(text).lower().encode(), np.uint8)
    return hashes(data, *spans(data))


def hash_of(word: str) -> int:
    """The hash that ``word`` has inside any text."""
    return int(word_hashes(word.encode())[0])


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` hashes; fewer than ``size`` make one run of all, none make none."""
    if not len(values):
        return values
    size = min(size, len(values))
    out = np.zeros(len(values) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + values[k : k + len(out)]
    return mix(out + np.uint64(size))


def windows_of_sizes(values: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the rising ``sizes`` that the values are enough for, with its :func:`windows`; a longer run goes on from a shorter."""
    out = np.zeros(len(values), np.uint64)
    done = 0
    for size in sizes:
        if size > len(values):
            return
        for k in range(done, size):
            out = out[: len(values) - k]
            out = out * np.uint64(_BASE) + values[k:]
        done = size
        yield size, mix(out + np.uint64(size))


class Lookup:
    """Membership in a small fixed set of hashes, by a table of their low bits before the hashes themselves."""

    def __init__(self, members: np.ndarray, bits: int = 16):
        self.members, self.low = np.sort(members), np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, bool)
        self.table[(members & self.low).astype(np.int64)] = True

    def holds(self, values: np.ndarray) -> np.ndarray:
        found = self.table[(values & self.low).astype(np.int64)]
        at = np.flatnonzero(found)
        some = values[at]
        found[at] = self.members[np.minimum(np.searchsorted(self.members, some), len(self.members) - 1)] == some
        return found
