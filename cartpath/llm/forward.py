"""Time-forward processing: totals passed up a tree through a priority queue that spills.

Nodes come sorted in reverse level order. Each takes the messages that its children have left for it,
adds its own part, and leaves the sum for its parent, which comes later in that order. The queue holds
messages, not nodes; beyond a fixed number of messages it writes a sorted run to an unnamed file, which
goes with the task, and merges the runs as it is emptied.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

Key = tuple[int, int, int]  # minus the depth, and the two halves of a node's identity
Sums = tuple[int, int, int]  # children, leaves, saved tokens
_BLOCK = 4096
_WIDTH = 6


class MessageQueue:
    """Messages (key and sums) in rising order of key, with at most ``most`` of them in memory besides one block of each run."""

    def __init__(self, most: int = 200_000):
        self.most, self.held, self.runs, self.spills = most, [], [], 0

    def push(self, key: Key, sums: Sums) -> None:
        heapq.heappush(self.held, (*key, *sums))
        if len(self.held) > self.most:
            self.spill()

    def spill(self) -> None:
        file = tempfile.TemporaryFile()
        np.array(sorted(self.held), np.int64).tofile(file)
        self.held, self.spills = [], self.spills + 1
        self._advance(self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple[int, ...]]:
        with file:
            file.seek(0)
            while len(block := np.fromfile(file, np.int64, _BLOCK * _WIDTH)):
                yield from map(tuple, block.reshape(-1, _WIDTH).tolist())

    def _advance(self, run: Iterator[tuple[int, ...]]) -> None:
        if (item := next(run, None)) is not None:
            heapq.heappush(self.runs, (item, id(run), run))

    def first(self) -> Key | None:
        """The smallest key that has messages."""
        ends = [x for x in (self.held[:1] and self.held[0], self.runs[:1] and self.runs[0][0]) if x]
        return min(ends)[:3] if ends else None

    def take(self, key: Key) -> Sums:
        """Remove the messages of the smallest key, which is ``key``, and add them up."""
        children = leaves = saved = 0
        while True:
            if self.held and self.held[0][:3] == key:
                item = heapq.heappop(self.held)
            elif self.runs and self.runs[0][0][:3] == key:
                item, _, run = heapq.heappop(self.runs)
                self._advance(run)
            else:
                return children, leaves, saved
            children, leaves, saved = children + item[3], leaves + item[4], saved + item[5]


def forward(nodes: Iterable[tuple[Key, Key, Sums]], count_leaves: bool, queue: MessageQueue) -> Iterator[tuple[Key, Sums, bool]]:
    """(key, sums, is a message) for every node, and for every node outside that gets messages from here.

    ``nodes`` gives key, key of the parent, and own sums, in rising order of key. A node's children are
    those that pass it a message; with ``count_leaves`` a node without any counts as a leaf.
    A message to the outside holds what all children in here have left for that node.
    """
    for key, parent, (children, leaves, saved) in nodes:
        while (earliest := queue.first()) is not None and earliest < key:
            yield earliest, queue.take(earliest), True
        got = queue.take(key) if earliest == key else (0, 0, 0)
        sums = children + got[0], leaves + got[1] + (count_leaves and not got[0]), saved + got[2]
        yield key, sums, False
        if key[0]:  # the root has no parent
            queue.push(parent, (int(count_leaves), *sums[1:]))
    while (earliest := queue.first()) is not None:
        yield earliest, queue.take(earliest), True
