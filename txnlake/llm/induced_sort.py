"""Suffix sorting by induction with queues that spill to disk.

The order of suffixes of one kind (larger or smaller than their successor) follows from the order
of the rest: scanning suffixes in order, each one induces its predecessor, which joins the queue
of its first symbol. The queues together are a priority queue by (first symbol, rank of the
successor), since ranks only grow while scanning. The seeds are the leftmost smaller-type (LMS)
suffixes: a first induction sorts their substrings, the names of these form a shorter string,
and that is ranked by doubling. Suffixes need to be told apart up to ``depth`` symbols only.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Positions all queues of a sort keep in memory; beyond it, whole queues go to disk.
MEMORY = 16_000_000
PART = 1 << 20
SYMBOLS = 257


class BucketQueues:
    """First-in first-out queues of positions, one for each symbol, in memory or spilled."""

    def __init__(self, memory: int = MEMORY):
        self.parts: list[list[np.ndarray | tuple[int, int]]] = [[] for _ in range(SYMBOLS)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Append positions to the queues of their symbols, keeping their order."""
        order = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[order]
        cuts = np.flatnonzero(np.diff(sorted_symbols)) + 1
        for part in np.split(order, cuts):
            if len(part):
                self.parts[int(symbols[part[0]])].append(positions[part])
        self.held += len(positions)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            # Beside Spark's own spills; the file has no name and ends with the task.
            where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.file = tempfile.TemporaryFile(dir=where if os.path.isdir(where) else None)
        self.file.seek(0, os.SEEK_END)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    at = self.file.tell()
                    self.file.write(part.tobytes())
                    parts[i] = (at, len(part))
        self.held = 0

    def take(self, symbol: int) -> list[np.ndarray]:
        """All of a queue in order, in few large parts; the queue is empty afterwards."""
        parts, self.parts[symbol] = self.parts[symbol], []
        out: list[np.ndarray] = []
        some: list[np.ndarray] = []
        held = 0
        for part in map(self._load, parts):
            some.append(part)
            held += len(part)
            if held >= PART:
                out.append(np.concatenate(some))
                some, held = [], 0
        return [*out, np.concatenate(some)] if some else out

    def _load(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            self.held -= len(part)
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(part[1] * 8), np.int64)


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their successor; the last symbol counts as smaller."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    smaller = np.append(text[:-1] < text[1:], True)
    # Equal neighbours take the type of the next place where symbols differ.
    where = np.where(differs, np.arange(n), n)
    return smaller[np.minimum.accumulate(where[::-1])[::-1]]


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, memory: int) -> BucketQueues:
    """Queues of all suffixes in order, from LMS positions in order (by first symbol at least)."""
    larger, smaller = BucketQueues(memory), BucketQueues(memory)
    pending, seeded = BucketQueues(memory), BucketQueues(memory)
    seeded.push(text[seeds], seeds)

    def before(positions: np.ndarray, kind: bool) -> np.ndarray:
        earlier = positions[positions > 0] - 1
        return earlier[small[earlier] == kind]

    for c in range(SYMBOLS):
        while wave := pending.take(c):
            for part in wave:
                larger.push(text[part], part)
                found = before(part, False)
                pending.push(text[found], found)
        for part in seeded.take(c):
            found = before(part, False)
            pending.push(text[found], found)
    result = BucketQueues(memory)
    for c in range(SYMBOLS - 1, -1, -1):
        while wave := pending.take(c):
            for part in wave:
                smaller.push(text[part], part)
                found = before(part, True)
                pending.push(text[found], found)
        own = larger.take(c)
        for part in reversed(own):
            found = before(part[::-1], True)
            pending.push(text[found], found)
        if c == 0:
            # The last symbol of the text has no successor to induce it.
            last = np.array([len(text) - 1])
            smaller.parts[0] = [*smaller.parts[0], last]
        for part in own:
            result.push(text[part], part)
        for part in reversed(smaller.take(c)):
            result.push(text[part], part[::-1])
    return result


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings, by text order, that keep their order; ``ordered`` is sorted."""
    length = np.append(np.diff(lms), 0) + 1
    size = np.zeros(len(text), np.int64)
    size[lms] = length
    a, b = ordered[:-1], ordered[1:]
    same = size[a] == size[b]
    step = 0
    rows = np.flatnonzero(same)
    while len(rows):
        rows = rows[size[a[rows]] > step]
        unequal = text[a[rows] + step] != text[b[rows] + step]
        same[rows[unequal]] = False
        rows = rows[~unequal]
        step += 1
    name = np.zeros(len(text), np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def _rank_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the reduced string, told apart up to ``depth`` text symbols.

    An LMS substring adds two symbols at least, so ``depth / 2`` names are enough.
    """
    rank, step = names, 1
    while step < depth // 2 + 1 and rank.max(initial=0) + 1 < len(rank):
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1
        pair = rank * (len(rank) + 1) + after
        _, rank = np.unique(pair, return_inverse=True)
        step *= 2
    return np.argsort(rank, kind="stable")


def suffix_order(text: np.ndarray, depth: int, memory: int = MEMORY) -> BucketQueues:
    """Queues that hold all positions of ``text`` in suffix order, up to ``depth`` symbols.

    Symbols are 0 to 256; the last symbol must be 0.
    """
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        queues = _induce(text, small, lms, memory)
        is_lms = np.zeros(len(text), bool)
        is_lms[lms] = True
        parts = [p[is_lms[p]] for c in range(SYMBOLS) for p in queues.take(c)]
        names = _names(text, lms, np.concatenate(parts))
        lms = lms[_rank_names(names, depth)]
    return _induce(text, small, lms, memory)


def repeated(text: np.ndarray, starts: np.ndarray, length: int, memory: int = MEMORY) -> np.ndarray:
    """Which of the marked ``starts`` (a mask over text) begin a ``length``-symbol string that also
    begins at another marked start: neighbours in suffix order with that long a common prefix."""
    out = np.zeros(len(text), bool)
    queues = suffix_order(text, length, memory)
    last = np.empty(0, np.int64)
    for c in range(SYMBOLS):
        for part in queues.take(c):
            own = part[starts[part]]
            for k in range(0, len(own), 1 << 16):
                row = np.concatenate([last, own[k : k + (1 << 16)]])
                if len(row) > 1:
                    equal = _common(text, row[:-1], row[1:], length)
                    out[row[:-1][equal]] = True
                    out[row[1:][equal]] = True
                last = row[-1:]
    return out


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of neighbours reaches ``length``; most differ early."""
    left = np.arange(len(a))
    for step in range(0, length, 8):
        width = min(8, length - step)
        at = np.arange(step, step + width)
        same = (text[a[left][:, None] + at] == text[b[left][:, None] + at]).all(axis=1)
        left = left[same]
    out = np.zeros(len(a), bool)
    out[left] = True
    return out
