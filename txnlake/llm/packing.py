"""Best-fit packing after a dominance reduction in the manner of Martello and Toth.

Whether pieces fit together depends on their lengths alone, so the plan is made on the counts of
each length (``capacity`` numbers, whatever the corpus): small sets that provably dominate every
other set with their longest piece are fixed for good, the remaining counts are packed best-fit
in falling order, and equal bins are kept as one bin and a count. Pieces then find their place
by their rank among pieces of equal length, which Spark counts in parallel.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlake.llm.common import stored
from txnlake.llm.tokens import encode_documents


def dominant_sets(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets (lengths, how many), taking their pieces out of ``counts``.

    For the longest piece j and room r = capacity - j:
    - nothing else fits: {j};
    - a piece of exactly r exists: {j, r}, since whatever else shares a bin with j sums to r at
      most and could take r's place;
    - no two others fit together: {j, k} with the longest k that fits;
    - two at most fit, and the best two sum to no more than k: {j, k} again.
    """
    capacity = len(counts) - 1
    fixed: list[tuple[tuple[int, ...], int]] = []

    def fix(lengths: tuple[int, ...], n: int) -> None:
        for length in lengths:
            counts[length] -= n
        fixed.append((lengths, n))

    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                step = _dominant(counts, j, capacity - j)
                if step is None:
                    break
                fix(*step)
                changed = True
    return fixed


def _dominant(counts: np.ndarray, j: int, room: int) -> tuple[tuple[int, ...], int] | None:
    own = int(counts[j])
    fits = counts[: room + 1].copy()
    if j <= room:
        fits[j] -= 1
    (lengths,) = np.nonzero(fits)
    if not len(lengths):
        # Only for j > capacity / 2 can all be fixed at once; below, j fits with itself.
        return (j,), own if j > room else 1
    k = int(lengths[-1])
    most = own // 2 if k == j else min(own, int(counts[k]))
    if k == room:
        return (j, k), most
    smallest = np.repeat(lengths, np.minimum(fits[lengths], 3))[:3]
    if len(smallest) < 2 or smallest[0] + smallest[1] > room:
        # With fewer pieces left the argument still holds, so all pairs may go at once.
        return (j, k), most
    if len(smallest) < 3 or smallest.sum() > room:
        if _best_pair(lengths, fits, room) <= k:
            return (j, k), 1
    return None


def _best_pair(lengths: np.ndarray, fits: np.ndarray, room: int) -> int:
    """The largest sum of two pieces that is no more than room; 0 if no two fit."""
    best, low, high = 0, 0, len(lengths) - 1
    while low <= high:
        total = int(lengths[low] + lengths[high])
        if total > room or (low == high and fits[lengths[low]] < 2):
            high -= 1
        else:
            best = max(best, total)
            low += 1
    return best


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: each piece goes where the least room is left."""
    capacity = len(counts) - 1
    bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room: bins of equal content
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        room = length
        while left and room <= capacity:
            groups = bins.get(room)
            if not groups:
                room += 1
                continue
            content, n = groups.popitem()
            take = min(n, left)
            if take < n:
                groups[content] = n - take
            # The bin just filled has the least room of all, so it takes further pieces first.
            more = 1 + (room - length) // length
            whole = min(take, left // more)
            if whole:
                key = content + (length,) * more
                spot = bins[room - more * length]
                spot[key] = spot.get(key, 0) + whole
                left -= whole * more
                back = take - whole
                if back:
                    groups[content] = groups.get(content, 0) + back
            else:
                key = content + (length,) * left
                spot = bins[room - len(key[len(content) :]) * length]
                spot[key] = spot.get(key, 0) + 1
                left = 0
                if take > 1:
                    groups[content] = groups.get(content, 0) + take - 1
        if left:
            each = capacity // length
            whole, rest = divmod(left, each)
            if whole:
                spot = bins[capacity - each * length]
                spot[(length,) * each] = spot.get((length,) * each, 0) + whole
            if rest:
                spot = bins[capacity - rest * length]
                spot[(length,) * rest] = spot.get((length,) * rest, 0) + 1
    return [(content, n) for groups in bins.values() for content, n in groups.items() if n]


def plan_bins(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Contents of all bins as (lengths, how many bins)."""
    left = counts.astype(np.int64).copy()
    fixed = dominant_sets(left)
    return fixed + best_fit(left)


def placements(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks, sequences of those ranks, offsets; ranks count on in order."""
    used: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for content, n in plan:
        offset = 0
        for length in content:
            rows[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {k: tuple(np.array(v, np.int64).T) for k, v in rows.items()}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (part, rank, doc_id, piece, start, length, ids_crc32, ids).

    Only documents longer than ``capacity`` are cut. ``rank`` counts pieces of equal length
    within the part (task). NULL or empty text is one piece of the end id alone.
    """
    encoded = encode_documents(docs, tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(raw, "<u2").astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    n = len(own)
                    crc = zlib.crc32(own.tobytes())
                    kept = own.astype("<u2").tobytes()
                    rows.append((part, int(seen[n]), doc_id, piece, start, n, crc, kept))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)]
                if rows
                else [pa.array([], t) for t in _PIECE_TYPES],
                _PIECE_NAMES,
            )

    return encoded.mapInArrow(
        run,
        "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary",
    )


_PIECE_NAMES = ["part", "rank", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
_PIECE_TYPES = [
    pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
]


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to stored pieces (part, rank, length, ...).

    ``pieces`` must be a stored table: ranks depend on the tasks that made them. Counts of each
    (part, length) become first ranks by a running sum over parts for each length.
    """
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    firsts = by_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("first"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    places = placements(plan_bins(counts))

    others = [c for c in pieces.columns if c not in ("part", "rank", "length")]
    ranked = pieces.join(firsts, ["part", "length"]).select(
        "length", (F.col("rank") + F.col("first")).alias("rank"), *others
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy() for i in range(2))
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                (at,) = np.nonzero(lengths == length)
                first, base, place = places[int(length)]
                k = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at], offset[at] = base[k] + ranks[at] - first[k], place[k]
            columns = [batch.column(i) for i in (0, *range(2, batch.num_columns))]
            names = ["length", *others, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    types = dict(ranked.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in ["length", *others])
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece of every document with its sequence, offset and ids (unsigned 16 bits)."""
    return pack(stored(cut_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)
