"""Queries against all rows, block by block: what both vector searches share.

Vectors are packed into blocks while they are read. Candidate blocks form stripes, queries form
groups of bounded size; every stripe meets every group in an equi-join on (stripe, group,
dimension), and a search function turns each meeting into the best few of each query. Partial
results are merged for each query by score, ties to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlake.llm.common import arrow_rows

#: Vectors of a candidate stripe and of a query group, about.
STRIPE_ROWS = 16_384
GROUP_ROWS = 2_048

#: search(candidate ids, candidate vectors, query ids, query vectors) gives for each query
#: (ids, scores), best first.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]

_BLOCK = "key int, dim int, ids binary, vectors binary"


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, embedding as array<double>) without NULL ids and vectors, and without vectors
    that are empty or hold NULL or non-finite components; without zero vectors unless ``zero``."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where("vec_id IS NOT NULL AND size(embedding) > 0").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    good = good.where(~F.coalesce(bad, F.lit(True)))
    return good if zero else good.where(F.exists("embedding", lambda x: x != 0))


def packed(vectors: DataFrame, keys: int, block_rows: int = 4096) -> DataFrame:
    """Blocks (key, dim, ids, vectors) of usable vectors; the key is a hash of the id."""
    dealt = vectors.withColumn("key", F.pmod(F.xxhash64("vec_id"), F.lit(keys)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(key: int, dim: int) -> pa.RecordBatch:
            parts = held.pop((key, dim))
            ids = np.concatenate([i for i, _ in parts]).tobytes()
            data = np.concatenate([v for _, v in parts]).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int32()), pa.array([dim], pa.int32()), pa.array([ids]), pa.array([data])],
                ["key", "dim", "ids", "vectors"],
            )

        for batch in batches:
            ids, lists, key = (batch.column(i) for i in range(3))
            ids, key = ids.to_numpy(), key.to_numpy()
            dims = pc.list_value_length(lists).to_numpy()
            flat, ends = lists.flatten().to_numpy(), np.cumsum(dims)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                data = flat[(ends[own] - dim)[:, None] + np.arange(dim)]
                for k in np.unique(key[own]):
                    at = key[own] == k
                    held.setdefault((int(k), int(dim)), []).append((ids[own[at]], data[at]))
            for full in [k for k, v in held.items() if sum(len(i) for i, _ in v) >= block_rows]:
                yield block(*full)
        for rest in list(held):
            yield block(*rest)

    return dealt.select("vec_id", "embedding", "key").mapInArrow(run, _BLOCK)


def unpack(ids: list[bytes], vectors: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer(b"".join(ids), np.int64),
        np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dim),
    )


def at_most_copies(ids: np.ndarray, vectors: np.ndarray, copies: int) -> np.ndarray:
    """Rows in id order without repeated (id, vector) rows, and without equal vectors beyond the
    first ``copies``: they tie with these, and ties go to smaller ids, so no query can want them."""
    order = np.argsort(ids, kind="stable")
    rows = np.ascontiguousarray(vectors[order] + 0.0)  # no negative zeros
    _, same = np.unique(rows.view(f"V{rows.shape[1] * 8}").ravel(), return_inverse=True)
    by = np.lexsort((np.arange(len(order)), same))
    run, own = same[by], ids[order][by]
    first = np.concatenate([[True], run[1:] != run[:-1]]) if len(run) else np.empty(0, bool)
    repeat = np.zeros(len(run), bool)
    repeat[1:] = (run[1:] == run[:-1]) & (own[1:] == own[:-1])
    by, run, first = by[~repeat], run[~repeat], first[~repeat]
    place = np.arange(len(run)) - np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
    return order[np.sort(by[place < copies])]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by falling score, then id; a repeated id counts once, by its best score."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    keep = np.sort(first)[:k]
    return ids[keep], scores[keep]


def search_all(
    candidates: DataFrame, queries: DataFrame, k: int, search: Search, score_type: str
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query.

    Both inputs are usable vectors (vec_id, embedding); vectors of unequal length do not meet,
    and a candidate with the query's own id is left out. Equal ids count once. A query without
    candidates has no row.
    """
    spark = candidates.sparkSession
    arrow_rows(spark, 4096)
    stripes = max(1, -(-candidates.count() // STRIPE_ROWS))
    groups = max(1, -(-queries.count() // GROUP_ROWS))
    together = lambda df, name: df.groupBy(F.col("key").alias(name), "dim").agg(
        F.collect_list("ids").alias(f"{name}_ids"), F.collect_list("vectors").alias(f"{name}_vectors")
    )
    left = together(packed(candidates, stripes), "stripe").withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    right = together(packed(queries, groups), "grp").withColumn(
        "stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    )
    meetings = left.join(right, ["stripe", "grp", "dim"]).select(
        "dim", "stripe_ids", "stripe_vectors", "grp_ids", "grp_vectors"
    )
    kind = pa.int64() if score_type == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(5)]
                ids, vectors = unpack(row[1], row[2], row[0])
                query_ids, query_vectors = unpack(row[3], row[4], row[0])
                found = search(ids, vectors, query_ids, query_vectors)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(query_ids),
                        pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())),
                        pa.array([f[1].tolist() for f in found], pa.list_(kind)),
                    ],
                    ["query_id", "ids", "scores"],
                )

    partial = meetings.mapInArrow(
        run, f"query_id long, ids array<long>, scores array<{score_type}>"
    ).select("query_id", F.explode(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))).alias("s"))
    once = partial.groupBy("query_id", F.col("s.vec_id").alias("vec_id")).agg(F.max("s.score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
