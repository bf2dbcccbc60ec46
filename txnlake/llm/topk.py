"""Exact top-k search on an impact-ordered index, score at a time.

Components are integers. Within a stripe of vectors, the postings of each dimension lie in
segments of one quantised impact. A query takes segments of all dimensions by falling impact and
adds their bounds to accumulators. At any time a vector's score lies between what it has gathered
and that plus the next impacts of the dimensions in which it was not met. When few enough vectors
can still reach the k-th lower bound, the rest are proved out and the few are scored exactly.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from txnlake.llm.vectors import at_most_copies, best, search_all, usable

LEVELS = 64
#: Shares of all postings after which a query tests whether the rest is proved out, and the
#: share of vectors that may still be possible when it turns to exact scores.
TESTS = (0.3, 0.4, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
FEW = 1 / 16


class ImpactIndex:
    """Postings in segments (dimension, level), with the true value range of each segment."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.n_distinct = len(np.unique(ids))
        n, dims = values.shape
        self.low, self.high = values.min(axis=0), values.max(axis=0)
        width = np.maximum((self.high - self.low) / LEVELS, 1e-9)
        level = np.minimum(((values - self.low) / width).astype(np.int64), LEVELS - 1)
        key = (level + np.arange(dims) * LEVELS).T.ravel()
        order = np.argsort(key, kind="stable")
        self.rows = order % n
        segments, self.starts = np.unique(key[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(key))
        self.dim = segments // LEVELS
        flat = values.T.ravel()[order]
        self.least = np.minimum.reduceat(flat, self.starts)
        self.most = np.maximum.reduceat(flat, self.starts)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        own = self.ids == query_id
        # Rows of the query's own id, and repeated ids, take no place among the k.
        want = k + int(own.sum()) + n - self.n_distinct
        possible = self._possible(query, want) if want < n else np.ones(n, bool)
        (members,) = np.nonzero(possible & ~own)
        exact = self.values[members].astype(np.int64) @ query.astype(np.int64)
        return best(self.ids[members], exact, k)

    def _possible(self, query: np.ndarray, want: int) -> np.ndarray:
        """A superset of the ``want`` best vectors, ties included."""
        n = len(self.ids)
        weight = query[self.dim]
        # Impacts count from the least contribution of a dimension, so all are >= 0.
        base = np.minimum(query * self.low, query * self.high)[self.dim]
        ends = weight * self.least - base, weight * self.most - base
        impact = np.maximum(*ends)
        order = np.argsort(-impact, kind="stable")
        order = order[weight[order] != 0]
        gap = float(np.abs(ends[1] - ends[0])[order].max(initial=0.0))
        length = (self.ends - self.starts)[order]
        reached = np.cumsum(length)
        upper, times = np.zeros(n), np.zeros(n, np.int64)
        begun = np.zeros(len(query), bool)
        top = np.zeros(len(query))
        np.maximum.at(top, self.dim[order], impact[order])
        done = 0
        possible = np.ones(n, bool)
        for share in TESTS:
            cut = int(np.searchsorted(reached, share * n * len(query))) + 1
            taken = order[done:cut]
            if not len(taken):
                continue
            rows = np.concatenate(
                [self.rows[a:b] for a, b in zip(self.starts[taken], self.ends[taken], strict=True)]
            )
            upper += np.bincount(rows, np.repeat(impact[taken], length[done:cut]), n)
            times += np.bincount(rows, minlength=n)
            begun[self.dim[taken]] = True
            done = cut
            following = impact[order[done]] if done < len(order) else 0.0
            # A dimension not begun gives its top impact at most; one in which the vector was
            # not met yet gives no more than the next segment of all.
            reach = upper + top[~begun].sum() + (begun.sum() - times) * following
            lower = upper - times * gap
            bar = np.partition(lower, n - want)[n - want]
            possible = reach >= bar - 1e-6 * (1 + abs(bar))
            if possible.sum() <= n * FEW + want:
                break
        return possible


def top_in_stripe(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, scale: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    values, query_values = np.floor(scale * vectors), np.floor(scale * queries)
    kept = at_most_copies(ids, values, k + 1)
    index = ImpactIndex(ids[kept], values[kept])
    return [index.search(int(i), q, k) for i, q in zip(query_ids, query_values, strict=True)]


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of floor(scale * x).

    Vectors that are NULL, empty, or hold NULL or non-finite components take no part; zero
    vectors do. Ties go to smaller ids; repeated rows count once; empty tables give no rows.
    Scores must fit a long.
    """
    search = partial(top_in_stripe, k=k, scale=scale)
    return search_all(usable(vectors, zero=True), usable(queries, zero=True), k, search, "long")
