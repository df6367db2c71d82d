"""Induced sorting of suffixes with common-prefix values, through queues that spill to disk.

Suffixes are S if smaller than the next suffix and L if larger; an S suffix after an L one is a seed.
From the sorted seeds, a scan of the buckets in rising order induces all L suffixes, and a scan in
falling order all S suffixes: whatever leaves the queue of a bucket pushes its predecessor into the
queue of the predecessor's first character. Suffix and common-prefix value travel together; the value
of an induced pair is one more than the least value between its two sources.

The seeds are sorted by the same induction (which sorts the pieces between seeds), and by the order of
the pieces' names. Queues take whole arrays, and beyond a fixed memory they move to a file.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

CAP = np.iinfo(np.int16).max
_STEP = 8  # bytes that are compared at once


class Queues:
    """One first-in-first-out queue of (position, common prefix) for each first character.

    Keys leave in rising or falling order, so together they are one priority queue. What exceeds
    ``memory`` bytes is appended to an unnamed file per key, which goes with the task.
    """

    def __init__(self, keys: int, memory: int, place: type = np.int64):
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(keys)]
        self.files: dict[int, object] = {}
        self.size, self.memory, self.place = 0, memory, place

    def push(self, key: int, position: np.ndarray, common: np.ndarray) -> None:
        self.held[key].append((position, common))
        self.size += position.nbytes + common.nbytes
        if self.size > self.memory:
            self.spill()

    def spill(self) -> None:
        for key, parts in enumerate(self.held):
            if parts:
                file = self.files.setdefault(key, tempfile.TemporaryFile())
                for position, common in parts:
                    np.array([len(position)], np.int64).tofile(file)
                    position.astype(self.place).tofile(file)
                    common.astype(np.int16).tofile(file)
                parts.clear()
        self.size = 0

    def pull(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Empty the queue of ``key`` in the order of its pushes, those made meanwhile included."""
        while self.held[key] or key in self.files:
            if file := self.files.pop(key, None):  # always older than what is held
                file.seek(0)
                while len(count := np.fromfile(file, np.int64, 1)):
                    yield np.fromfile(file, self.place, count[0]), np.fromfile(file, np.int16, count[0])
                file.close()
            else:
                position, common = (np.concatenate(x) for x in zip(*self.held[key], strict=True))
                self.held[key].clear()
                self.size -= position.nbytes + common.nbytes
                yield position, common


class Text:
    """Strings, none empty, laid end to end, each closed by a 0 that no other character equals; bytes are stored plus 1."""

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) + 1 for s in strings], np.int64)
        n = int(lengths.sum())
        self.place = np.int32 if n < np.iinfo(np.int32).max else np.int64  # there are many positions, in many arrays
        self.chars = np.zeros(n, np.int16)
        self.starts = np.cumsum(lengths) - lengths
        joined = b"\0".join(strings) + bytes(_STEP)
        self.eight = np.ndarray(n, "<u8", joined, 0, (1,))  # the bytes from each place on
        self.chars[:] = np.frombuffer(joined, np.uint8, n)
        self.chars += 1
        self.chars[self.starts + lengths - 1] = 0
        change = np.ones(n, bool)  # the last of a run of equal characters
        change[:-1] = (self.chars[:-1] != self.chars[1:]) | (self.chars[:-1] == 0)
        places = np.flatnonzero(change).astype(self.place)
        sizes = np.diff(places, prepend=self.place(-1))
        at = np.arange(n, dtype=self.place)
        self.run = np.minimum(np.repeat(places, sizes) - at + 1, CAP).astype(np.int16)
        following = np.repeat(self.chars[np.minimum(places + 1, n - 1)], sizes)
        self.is_s = (self.chars < following) | (self.chars == 0)
        self.seeds = (np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]) + 1).astype(self.place)
        self.left = np.repeat((self.starts + lengths - 1).astype(self.place), lengths) - at  # characters before the closing 0


def _induce(text: Text, seeds: np.ndarray, common: np.ndarray, memory: int, out: Callable) -> None:
    """Call ``out(positions, common)`` with all suffixes in falling order, from seeds in rising order.

    ``common`` of an item is what it shares with the item before it in the order it is given in.
    """
    chars, keys = text.chars, 257
    bounds = np.searchsorted(chars[seeds], np.arange(keys + 1))
    rising, falling, finished = (Queues(keys, memory, text.place) for _ in range(3))

    def push(queues: Queues, position: np.ndarray, value: np.ndarray, least: np.ndarray, select: np.ndarray) -> None:
        """Push the selected predecessors. ``least`` is, for each key, the least value since its last push."""
        at = np.flatnonzero(select)
        before = position[at] - 1
        first = chars[before]
        order = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        total = int(value.min())
        touched = np.unique(first)
        for group in np.split(order, cuts) if len(order) else ():
            key, where = int(first[group[0]]), at[group]
            lows = np.empty(len(where), np.int64)
            lows[0] = min(least[key], int(value[: where[0] + 1].min()))
            if len(where) > 1:
                lows[1:] = np.minimum.reduceat(value[: where[-1] + 1], where[:-1] + 1)
            least[key] = int(value[where[-1] + 1 :].min()) if where[-1] + 1 < len(value) else CAP
            queues.push(key, before[group], np.minimum(lows + 1, CAP).astype(np.int16))
        others = np.ones(keys, bool)
        others[touched] = False
        least[others] = np.minimum(least[others], total)

    for key in range(keys):
        least = np.zeros(keys, np.int64)  # the first of a bucket shares one character with what another bucket pushed
        last = None

        for position, value in rising.pull(key):
            if last is None:
                value[0] = 0  # its neighbour is of another bucket
            last = position[-1]
            finished.push(key, position, value)
            push(rising, position, value, least, (position > 0) & (chars[position - 1] >= key))
        own = slice(bounds[key], bounds[key + 1])
        if own.stop > own.start:
            position, value = seeds[own], common[own].copy()
            value[0] = min(text.run[last], text.run[position[0]]) if last is not None else 0
            push(rising, position, value, least, (position > 0) & (chars[position - 1] > key))
    for key in range(keys - 1, -1, -1):
        least = np.zeros(keys, np.int64)
        last = None
        pending = falling.pull(key)
        if key == 0:  # the closing characters, by place
            pending = [(seeds[: bounds[1]][::-1], np.zeros(bounds[1], np.int16))] if bounds[1] else []
        for position, value in pending:
            if last is None:
                value[0] = 0
            out(position, value)
            last = position[-1]
            if key:
                push(falling, position, value, least, (position > 0) & (chars[position - 1] <= key) & (chars[position - 1] > 0))
        # The L suffixes, which were found in rising order: turned around, a value belongs to the later neighbour.
        parts = list(finished.pull(key))
        if parts:
            position = np.concatenate([p for p, _ in parts])[::-1]
            value = np.concatenate([v for _, v in parts])[::-1]
            value = np.concatenate([[0], value[:-1]]).astype(np.int16)
            value[0] = min(text.run[last], text.run[position[0]]) if last is not None else 0
            out(position, value)
            push(falling, position, value, least, (position > 0) & (chars[position - 1] < key) & (chars[position - 1] > 0))


def common_prefix(text: Text, a: np.ndarray, b: np.ndarray, cap: int | np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes, at most ``cap``."""
    most = np.minimum(np.minimum(text.left[a], text.left[b]), cap)
    shared = np.zeros(len(a), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        differ = text.eight[a[live] + shared[live]] ^ text.eight[b[live] + shared[live]]
        # Bytes below the lowest bit that differs, all if none does; what follows a closing 0 is beyond ``most``.
        same = (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
        shared[live] += same
        live = live[(same == _STEP) & (shared[live] < most[live])]
    return np.minimum(shared, most)


def _first(new: np.ndarray) -> np.ndarray:
    """For each place, where its group begins; ``new`` tells the places that begin one."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _shared(new: np.ndarray) -> np.ndarray:
    """Places in groups of more than one."""
    return ~(new & np.append(new[1:], True))


def _sorted_seeds(text: Text, memory: int) -> np.ndarray:
    """The seed suffixes in rising order."""
    seeds = text.seeds
    found: list[np.ndarray] = []
    rough = seeds[np.argsort(text.chars[seeds], kind="stable")]
    is_seed = np.zeros(len(text.chars), bool)
    is_seed[seeds] = True
    _induce(text, rough, np.zeros(len(rough), np.int16), memory, lambda p, _: found.append(p[is_seed[p]]))
    order = np.concatenate(found)[::-1]
    # Pieces from seed to seed, end included; closing characters are all different.
    number = np.zeros(len(text.chars), text.place)
    number[seeds] = np.arange(len(seeds))
    lengths = np.diff(np.append(seeds, seeds[-1])) + 1
    index = number[order]
    a, b = order[:-1], order[1:]
    size = lengths[index[:-1]]
    equal = (size == lengths[index[1:]]) & (text.chars[a] > 0)
    at = np.flatnonzero(equal)
    equal[at] = common_prefix(text, a[at], b[at], size[at]) >= size[at]
    # The rank of a piece is the number of smaller ones. The reduced text: its suffixes in order, by doubling the
    # compared length until all differ; those that differ from all others already are not looked at again.
    new = np.concatenate([[True], ~equal])
    rank = np.zeros(len(seeds), np.int64)
    rank[index] = _first(new)
    live = index[_shared(new)]
    step = 1
    while len(live):
        second = np.where(live + step < len(rank), rank[np.minimum(live + step, len(rank) - 1)] + 1, 0)
        pair = rank[live] * (len(rank) + 1) + second
        order = np.argsort(pair, kind="stable")
        live, pair = live[order], pair[order]
        old = rank[live]
        new = np.concatenate([[True], np.diff(pair) != 0])
        rank[live] = old + _first(new) - _first(np.concatenate([[True], np.diff(old) != 0]))
        live = live[_shared(new)]
        step *= 2
    ordered = np.zeros(len(seeds), text.place)
    ordered[rank] = seeds
    return ordered


def suffixes(strings: list[bytes], cap: int, memory: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in falling order as arrays of positions in the joined text, with the common prefix to the one before, up to ``cap``."""
    text = Text(strings)
    seeds = _sorted_seeds(text, memory)
    common = np.zeros(len(seeds), np.int64)
    common[1:] = common_prefix(text, seeds[:-1], seeds[1:], cap)
    made: list[tuple[np.ndarray, np.ndarray]] = []
    _induce(text, seeds, common.astype(np.int16), memory, lambda p, v: made.append((p, v)))
    yield from made


def repeated(strings: list[bytes], length: int, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(index of the string, start) of every place whose next ``length`` bytes also start at another place."""
    if not strings:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = Text(strings)
    seeds = _sorted_seeds(text, memory)
    common = np.zeros(len(seeds), np.int16)
    common[1:] = common_prefix(text, seeds[:-1], seeds[1:], length)
    marks = np.zeros(len(text.chars), bool)
    previous = [-1]

    def look(position: np.ndarray, value: np.ndarray) -> None:
        hit = np.flatnonzero(value >= length)
        marks[position[hit]] = True
        marks[position[hit - 1][hit > 0]] = True
        if len(hit) and hit[0] == 0 and previous[0] >= 0:
            marks[previous[0]] = True
        previous[0] = int(position[-1])

    _induce(text, seeds, common, memory, look)
    places = np.flatnonzero(marks)
    owner = np.searchsorted(text.starts, places, side="right") - 1
    return owner, places - text.starts[owner]
