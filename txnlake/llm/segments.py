"""Hard negatives by segment summaries.

A vector's dimensions are cut into segments. Of each segment its mean and its deviation from it
are kept: the inner product of two vectors over a segment of length n is n times the product of
the means, plus or minus at most the product of the deviations. Coarse segments bound all scores of
a stripe of vectors at once; vectors that can still matter to a query are bounded again by finer
segments, and those left are scored exactly.

Vectors are packed into blocks, dealt to stripes by a hash of their id. A stripe is held by one
task while blocks of queries stream past it, so candidates are never copied; queries, the smaller
side, are sent once to each stripe.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlake.llm.common import stored

#: Vectors of a stripe at most, about, and at least where there are fewer stripes than cores.
STRIPE_ROWS = 65_536
LEAST_ROWS = 4_096
BLOCK_ROWS = 1_024
#: Queries that are compared with a stripe at a time.
CHUNK = 32
#: Segments of each level, from coarse to fine; levels as fine as the vectors are left out.
LEVELS = (1, 4, 16)

_BLOCK = "key int, payload binary"


def labelled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part: no NULL id, label or vector, and no
    empty vector or NULL or non-finite component."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0")
        .where(~F.coalesce(bad, F.lit(True)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
    )


def in_blocks(rows: DataFrame, keys: int) -> DataFrame:
    """Blocks (key, payload) of rows with a vec_id, by a hash of it; a payload is an Arrow stream
    of about BLOCK_ROWS rows."""
    dealt = rows.withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(keys)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def block(key: int) -> pa.RecordBatch:
            table = pa.Table.from_batches(held.pop(key)).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), payload], ["key", "payload"])

        for batch in batches:
            key = batch.column("key").to_numpy()
            rest = batch.drop_columns(["key"])
            for k in np.unique(key).tolist():
                held.setdefault(k, []).append(rest.take(pa.array(np.flatnonzero(key == k))))
                if sum(b.num_rows for b in held[k]) >= BLOCK_ROWS:
                    yield block(k)
        for k in list(held):
            yield block(k)

    return dealt.mapInArrow(run, _BLOCK)


def _table(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _matrices(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and vectors of each length."""
    lists = table.column("embedding").combine_chunks()
    dims = lists.value_lengths().to_numpy()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(dims)
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        yield own, flat[(ends[own] - dim)[:, None] + np.arange(dim)]


class Summaries:
    """Means and deviations of the segments of vectors, level by level."""

    def __init__(self, values: np.ndarray):
        self.values = values
        dims = values.shape[1]
        self.levels = []
        for n in LEVELS:
            if n >= dims:
                break
            edges = np.linspace(0, dims, n + 1).astype(int)
            mean = np.empty((len(values), n))
            spread = np.empty((len(values), n))
            for j, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                mean[:, j] = values[:, a:b].mean(axis=1)
                # The products of means count once for each dimension of the segment.
                spread[:, j] = np.sqrt(((values[:, a:b] - mean[:, j, None]) ** 2).sum(axis=1))
                mean[:, j] *= np.sqrt(b - a)
            self.levels.append((mean, spread))
        self.most = float(np.abs(values).max(initial=0.0))

    def taken(self, rows: np.ndarray) -> Summaries:
        out = object.__new__(Summaries)
        out.values, out.most = self.values[rows], self.most
        out.levels = [(mean[rows], spread[rows]) for mean, spread in self.levels]
        return out

    def bounds(self, other: Summaries, level: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that the scores with some rows of ``other`` can be."""
        (mean, spread), (means, spreads) = self.levels[level], other.levels[level]
        middle = mean @ means[columns].T
        room = spread @ spreads[columns].T
        room += 1e-9 * (np.abs(middle) + room) + 1e-6  # sums of floats are a little off
        return middle - room, middle + room

    def scores(self, other: Summaries, columns: np.ndarray) -> np.ndarray:
        """Exact integer scores with some rows of ``other``; they must fit a long."""
        if self.most * other.most * self.values.shape[1] < 1 << 53:
            return np.rint(self.values @ other.values[columns].T).astype(np.int64)
        return self.values.astype(np.int64) @ other.values[columns].astype(np.int64).T


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, nothing where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _first(scores: np.ndarray, columns: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k highest scores, ties in their order."""
    if len(columns) > 4 * k:
        own = scores[columns]
        columns = columns[own >= np.partition(own, len(own) - k)[len(own) - k]]
    return columns[np.argsort(-scores[columns], kind="stable")[:k]]


class Stripe:
    """Candidates of one length, sorted by id. Of rows with one id the one of least label, then
    least vector, counts."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, scale: int):
        order = np.argsort(ids, kind="stable")
        if len(np.unique(ids)) < len(ids):
            order = np.lexsort([*vectors.T[::-1], labels, ids])
            order = order[np.append(True, np.diff(ids[order]) != 0)]
        self.ids, self.labels = ids[order], labels[order]
        self.of = Summaries(np.floor(scale * vectors[order]))

    def positives(self, ids: np.ndarray, label: int, queries: Summaries, k: int) -> Iterator[tuple]:
        """(query, id, score): the k best rows of the label for each query but itself."""
        columns = np.flatnonzero(self.labels == label)
        bar = np.full(len(ids), -np.inf)
        own = ids[:, None] == self.ids[columns]
        for level in range(len(queries.levels)):
            if not len(columns):
                return
            low, high = queries.bounds(self.of, level, columns)
            low[own] = high[own] = -np.inf
            bar = np.maximum(bar, _kth(low, k))
            open_ = (high >= bar[:, None]).any(axis=0)
            columns, own = columns[open_], own[:, open_]
        scores = queries.scores(self.of, columns)
        for i, query in enumerate(ids.tolist()):
            for c in _first(scores[i], np.flatnonzero(~own[i]), k):
                yield query, int(self.ids[columns[c]]), int(scores[i, c])

    def negatives(
        self, ids: np.ndarray, label: int, queries: Summaries, low_at: np.ndarray, high_at: np.ndarray, k: int
    ) -> Iterator[tuple]:
        """(query, window, id, score): the k best rows of other labels whose score lies in each
        of the query's windows; a window without numbers is empty."""
        columns = np.flatnonzero(self.labels != label)
        bars = np.full(low_at.shape, -np.inf)
        for level in range(len(queries.levels)):
            if not len(columns):
                return
            low, high = queries.bounds(self.of, level, columns)
            needed = np.zeros(len(columns), bool)
            for w in range(low_at.shape[1]):
                least, most = low_at[:, w, None], high_at[:, w, None]
                sure = np.where((low >= least) & (high <= most), low, -np.inf)
                bars[:, w] = np.maximum(bars[:, w], _kth(sure, k))
                possible = (high >= np.maximum(least, bars[:, w, None])) & (low <= most)
                needed |= possible.any(axis=0)
            columns = columns[needed]
        scores = queries.scores(self.of, columns)
        for i, query in enumerate(ids.tolist()):
            for w in range(low_at.shape[1]):
                if np.isnan(low_at[i, w]):
                    continue
                inside = np.flatnonzero((scores[i] >= low_at[i, w]) & (scores[i] <= high_at[i, w]))
                for c in _first(scores[i], inside, k):
                    yield query, w, int(self.ids[columns[c]]), int(scores[i, c])


def stripes_of(payloads: list[bytes], scale: int) -> dict[int, Stripe]:
    tables = pa.concat_tables([_table(p) for p in payloads]).combine_chunks()
    ids, labels = (tables.column(c).to_numpy() for c in ("vec_id", "label"))
    return {v.shape[1]: Stripe(ids[own], labels[own], v, scale) for own, v in _matrices(tables)}


#: search(stripe, query table rows, their ids, label and summaries) gives rows of the result.
Search = Callable[[Stripe, pa.Table, np.ndarray, int, Summaries], Iterator[tuple]]


def _chunks(table: pa.Table, scale: int) -> Iterator[tuple[int, pa.Table, np.ndarray, int, Summaries]]:
    """Queries of one length and label, CHUNK at a time."""
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    for own, vectors in _matrices(table):
        every = Summaries(np.floor(scale * vectors))
        for label in np.unique(labels[own]).tolist():
            of_label = np.flatnonzero(labels[own] == label)
            for a in range(0, len(of_label), CHUNK):
                at = of_label[a : a + CHUNK]
                yield vectors.shape[1], table.take(own[at]), ids[own[at]], label, every.taken(at)


def stream_past(
    candidates: DataFrame, queries: DataFrame, stripes: int, search: Search, names: list[str], scale: int
) -> DataFrame:
    """Rows of ``names`` (longs) from every meeting of a stripe and a block of queries."""
    sent = queries.withColumn("key", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    both = candidates.select("key", F.lit(0).alias("side"), "payload").unionByName(
        sent.select("key", F.lit(1).alias("side"), "payload")
    )
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, held = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                key, side = batch.column("key")[i].as_py(), batch.column("side")[i].as_py()
                payload = batch.column("payload")[i].as_py()
                if key != current:
                    current, waiting, held = key, [], {}
                if side == 0:
                    waiting.append(payload)
                    continue
                if waiting:
                    held, waiting = stripes_of(waiting, scale), []
                for dim, table, ids, label, summaries in _chunks(_table(payload), scale):
                    if dim in held:
                        found = list(zip(*search(held[dim], table, ids, label, summaries), strict=True))
                        if found:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

    ordered = both.repartitionByRange(stripes, "key").sortWithinPartitions("key", "side")
    return ordered.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _positives(stripe: Stripe, table: pa.Table, ids: np.ndarray, label: int, queries: Summaries, k: int):
    return stripe.positives(ids, label, queries, k)


def _negatives(
    stripe: Stripe, table: pa.Table, ids: np.ndarray, label: int, queries: Summaries, k: int, least: int, most: int
):
    scores = table.column("positive_scores").to_pylist()
    width = max(map(len, scores))
    low, high = np.full((len(ids), width), np.nan), np.full((len(ids), width), np.nan)
    for i, own in enumerate(scores):
        # least * positive <= 100 * negative <= most * positive, in whole numbers.
        low[i, : len(own)] = [-(-least * s // 100) for s in own]
        high[i, : len(own)] = [most * s // 100 for s in own]
    return stripe.negatives(ids, label, queries, low, high, k)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor
    and each of its first positives, the first rows of another label that score from ``least`` to
    ``most`` percent of the positive.

    Scores are inner products of floor(scale * x) and must fit a long; ties go to smaller ids.
    Rows with a NULL id, label or vector, an empty vector or a NULL or non-finite component take
    no part; vectors of unequal length do not meet; repeated rows count once, and of different
    rows with one id (and length) the one of least label, then least vector; further columns, whatever
    their names, change nothing; empty tables give no rows, nor do anchors without positives
    or positives without negatives in range.
    """
    spark = vectors.sparkSession
    usable = labelled(vectors)
    n = usable.count()
    stripes = max(1, -(-n // STRIPE_ROWS), min(spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
    candidates = stored(in_blocks(usable, stripes), "segments-candidates")
    # One row an anchor; anchors are few beside the candidates.
    chosen = (
        labelled(anchors)
        .groupBy("vec_id", F.size("embedding").alias("dim"))
        .agg(F.min(F.struct("label", "embedding")).alias("row"))
        .select("vec_id", "dim", "row.label", "row.embedding")
    )
    chosen = stored(chosen, "segments-anchors")
    groups = max(1, -(-chosen.count() // BLOCK_ROWS))
    asked = in_blocks(chosen.drop("dim"), groups)
    names = ["anchor_id", "positive_id", "positive_score", "dim"]

    def with_dim(stripe, table, ids, label, queries):
        dim = queries.values.shape[1]
        return ((*row, dim) for row in _positives(stripe, table, ids, label, queries, n_positives))

    found = stream_past(candidates, asked, stripes, with_dim, names, scale)
    order = W.partitionBy("anchor_id", "dim").orderBy(F.desc("positive_score"), "positive_id")
    first = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < n_positives)
    # At most n_positives of each anchor.
    listed = first.groupBy("anchor_id", "dim").agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p")
    )
    listed = stored(listed, "segments-positives")
    known = chosen.join(listed, (F.col("vec_id") == F.col("anchor_id")) & (chosen.dim == listed.dim))
    asked = in_blocks(
        known.select("vec_id", "label", "embedding", F.col("p.positive_score").alias("positive_scores")), groups
    )
    names = ["anchor_id", "place", "negative_id", "negative_score", "dim"]

    def in_range(stripe, table, ids, label, queries):
        dim = queries.values.shape[1]
        rows = _negatives(stripe, table, ids, label, queries, n_negatives, least, most)
        return ((*row, dim) for row in rows)

    found = stream_past(candidates, asked, stripes, in_range, names, scale)
    order = W.partitionBy("anchor_id", "dim", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
    positives = listed.select("anchor_id", "dim", F.inline("p"))
    return best.join(positives, ["anchor_id", "dim", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
