"""Nearest neighbours by a block matrix join with int8 tiles and error bounds.

Every vector is one byte a component and a scale. A tile of integer products estimates all inner
products of a query chunk and a candidate stripe; the norms of what rounding lost bound the error
of each. Only pairs whose upper bound reaches the k-th lower bound are computed again in double
precision from the original vectors, so the tiles never decide a rank.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame

from txnlake.llm.vectors import at_most_copies, best, search_all, usable

CHUNK = 256


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 components, scales, norms of the rounded vectors, norms of what rounding lost."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    small = np.clip(np.rint(vectors / scale[:, None]), -127, 127).astype(np.int8)
    rounded = small * scale[:, None]
    return small, scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(vectors - rounded, axis=1)


def _tile(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer products; exact in float32 while sums stay below 2^24, else in float64."""
    kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return queries.astype(kind) @ candidates.astype(kind).T


def nearest_in_stripe(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    kept = at_most_copies(ids, vectors, k + 1)
    ids, vectors = ids[kept], vectors[kept]
    small, scale, size, lost = quantise(vectors)
    norm = np.linalg.norm(vectors, axis=1)
    q_small, q_scale, q_size, q_lost = quantise(queries)
    out = []
    for c in range(0, len(queries), CHUNK):
        own = slice(c, c + CHUNK)
        about = _tile(q_small[own], small).astype(np.float64)
        about *= q_scale[own][:, None]
        about *= scale
        # |q.x - q'.x'| <= |q - q'| |x| + |q'| |x - x'|, and a little for float sums.
        error = np.outer(q_lost[own], norm) + np.outer(q_size[own], lost)
        error += 1e-12 * np.outer(q_size[own] + q_lost[own], norm)
        about[query_ids[own][:, None] == ids] = -np.inf
        lower = about - error
        want = min(k, len(ids))
        # A repeated id counts once, so k rows may be fewer than k candidates.
        want = min(len(ids), want + len(ids) - len(np.unique(ids)))
        bar = np.partition(lower, len(ids) - want, axis=1)[:, len(ids) - want]
        rows, columns = np.nonzero((about + error >= bar[:, None]) & (about > -np.inf))
        scores = np.einsum("ij,ij->i", queries[own][rows], vectors[columns])
        ends = np.searchsorted(rows, np.arange(about.shape[0] + 1))
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            out.append(best(ids[columns[a:b]], scores[a:b], k))
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of largest inner product.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part;
    equal vectors are ordered by id; repeated rows count once; empty tables give no rows.
    """
    search = partial(nearest_in_stripe, k=k)
    return search_all(usable(vectors, zero=False), usable(queries, zero=False), k, search, "double")
