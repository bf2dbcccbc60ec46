"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are lower-cased words and word beginnings of four and five letters. All terms of the chosen
examples count; document frequencies come from all documents. A term that no example has scales
all cosines of its text alike, so it changes neither neighbours nor votes and is not kept.
Examples lie in blocks that know the largest weight of each of their commonest terms and the
share of each example in these. The commonest terms of a block are multiplied as a matrix in single
precision; all others are added from postings first, so blocks that cannot reach the nearest few
with what is left are skipped. What may be among the nearest is scored again in double precision.
Votes are weighted by similarity, and a monotone curve fitted on the examples,
each without its own vote, turns them into calibrated scores.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import partitions, stored, whole_text

#: Documented bound of the fit: labelled rows that serve as examples, by hash of doc_id.
MAX_EXAMPLES = 20_000
NEIGHBOURS = 32
#: Examples of a block, and how many of its terms lie in its matrix.
BLOCK, COMMON = 2048, 1536
#: Pieces of texts that a worker remembers. Speed only.
PIECES = 400_000
#: Queries searched at once.
QUERIES = 256
#: More than single precision can take from or add to a cosine of unit vectors.
SLACK = 1e-4
PREFIXES = (4, 5)

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def text_terms(text: str) -> set[str]:
    """Words, and their beginnings marked by a star."""
    words = set(_WORD.findall(text.lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) >= n} for n in PREFIXES))


def choose_examples(labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """At most ``limit`` training rows (doc_id, toxic), those of smallest hash.

    A doc_id labelled more than once is toxic if any of its labels says so; NULLs are left out.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    return known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def example_terms(docs: DataFrame, examples: DataFrame) -> list[str]:
    """All terms of the examples' texts, those of most texts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text_terms(text))
        terms = list(counts)
        for k in range(0, len(terms), 50_000):
            own = terms[k : k + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.string()), pa.array([counts[t] for t in own], pa.int64())], ["term", "n"]
            )

    texts = docs.join(F.broadcast(examples), "doc_id").select(whole_text().alias("text"))
    counted = texts.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    return counted.sort_by([("n", "descending"), ("term", "ascending")]).column("term").to_pylist()


class _Pieces(dict):
    """Numbers of the known terms of each piece between white space, as 32-bit integers."""

    def __init__(self, terms: list[str]):
        data = np.arange(len(terms), dtype=np.int32).tobytes()
        self.words, self.beginnings = {}, {}
        for i, t in enumerate(terms):
            own, name = (self.beginnings, t[:-1]) if t[-1] == "*" else (self.words, t)
            own[name] = data[4 * i : 4 * i + 4]

    def _of(self, word: str) -> bytes:
        found = self.words.get(word, b"")
        for n in PREFIXES:
            if len(word) >= n:
                found += self.beginnings.get(word[:n], b"")
        return found

    def __missing__(self, piece: str) -> bytes:
        core = piece.rstrip(".,")
        data = self._of(core) if core.isalpha() else b"".join(map(self._of, _WORD.findall(piece)))
        self[piece] = data
        return data


def _counter(terms: list[str]) -> Callable[[list[str]], list[tuple[np.ndarray, np.ndarray, bool]]]:
    """A function from texts to the known terms (ascending) of each, their counts, and whether it has no word."""
    known = _Pieces(terms)

    def count(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        if len(known) > PIECES:
            known.clear()
        # No word goes across white space.
        cut = [t.lower().split() for t in texts]
        data = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        ids = np.frombuffer(b"".join(data), np.int32).astype(np.int64)
        first = np.arange(len(cut) + 1) * len(terms)
        keys = np.sort(np.repeat(first[:-1], [len(d) // 4 for d in data]) + ids)
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        found, times = keys[starts], np.diff(starts, append=len(keys))
        bounds = np.searchsorted(found, first).tolist()
        out = []
        for i, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            bare = a == z and not any(map(_WORD.search, cut[i]))
            out.append((found[a:z] - first[i], times[a:z], bare))
        return out

    return count


def _packed(values: np.ndarray) -> bytes:
    """The bytes each number needs, then all numbers as planes of so many bytes, which files compress well."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8 or 1
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T[:width]
    return bytes([width]) + planes.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<u4").ravel().astype(np.int64)


def _terms_of(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def term_vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Stored (doc_id, th, terms, counts, bare) of every document.

    ``terms`` are steps between ascending numbers, both are packed; th is a text hash; a bare
    text has no word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(shared.value)
        for batch in batches:
            found = count(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([_packed(np.diff(t, prepend=0)) for t, _, _ in found], pa.binary()),
                    pa.array([_packed(n) for _, n, _ in found], pa.binary()),
                    pa.array([bare for _, _, bare in found], pa.bool_()),
                ],
                ["doc_id", "th", "terms", "counts", "bare"],
            )

    text = whole_text()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    schema = "doc_id long, th long, terms binary, counts binary, bare boolean"
    vectors = stored(texts.mapInArrow(run, schema), "toxicity-vectors")
    shared.destroy()
    return vectors


def document_frequency(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents have each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, np.int64)
        for batch in batches:
            own = [_terms_of(t) for t in batch.column(0).to_pylist()]
            if own:
                counts += np.bincount(np.concatenate(own), minlength=n_terms)
        (terms,) = np.nonzero(counts)
        for k in range(0, len(terms), 50_000):
            own = terms[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(counts[own], pa.int64())], ["t", "n"])

    found = vectors.select("terms").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(n_terms)
    frequency[found.column("t").to_numpy()] = found.column("n").to_numpy()
    return frequency


class _Tile:
    """One block: a matrix of its commonest terms, the largest weight of each, the length of each
    example in them, and their counts (by code from 1) to score a few examples exactly."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, codes: np.ndarray, weights: np.ndarray, n_rows: int):
        own, often = np.unique(terms, return_counts=True)
        common = np.sort(own[np.argsort(-often, kind="stable")[:COMMON]])
        self.column = np.full(common[-1] + 1, -1, np.int32)
        self.column[common] = np.arange(len(common))
        column = self.of(terms)
        self.inside = column >= 0
        at = rows[self.inside], column[self.inside]
        self.codes = np.zeros((n_rows, len(common)), np.min_scalar_type(int(codes.max()) + 1))
        self.codes[at] = codes[self.inside] + 1
        self.matrix = np.zeros((len(common), n_rows), np.float32)
        self.matrix[at[::-1]] = weights[self.inside]
        self.top = self.matrix.max(axis=1)
        self.length = np.linalg.norm(self.matrix, axis=0)

    def of(self, terms: np.ndarray) -> np.ndarray:
        """The columns of terms, -1 for those not in the matrix."""
        return np.where(terms < len(self.column), self.column[np.minimum(terms, len(self.column) - 1)], -1)


class _Tiles:
    """All blocks, and the postings of what is in no matrix. ``order`` has the row of each place."""

    def __init__(self, index: BlockMaxIndex):
        n, n_terms = len(index.norm), len(index.idf)
        size = np.diff(index.start)
        self.order = index.order
        self.scale = 1.0 / index.norm[self.order]
        #: Weight of a count before idf and norm, by code; 0 stands for a term not there.
        self.tf = np.concatenate([[0.0], index.tf])
        self.bits = n.bit_length()
        kind = np.uint32 if self.bits + len(index.tf).bit_length() <= 32 else np.uint64
        self.spans = [(a, min(a + BLOCK, n)) for a in range(0, n, BLOCK)]
        self.blocks: list[_Tile] = []
        rest, total = [], np.zeros(n_terms, np.int64)
        for a, z in self.spans:
            rows = self.order[a:z]
            place = np.repeat(np.arange(z - a, dtype=np.int32), size[rows])
            cuts = list(map(slice, index.start[rows].tolist(), index.start[rows + 1].tolist()))
            terms = np.concatenate([index.terms[c] for c in cuts])
            codes = np.concatenate([index.code[c] for c in cuts])
            weights = (index.tf[codes] * index.idf[terms] / index.norm[rows][place]).astype(np.float32)
            block = _Tile(place, terms, codes, weights, z - a)
            outside = ~block.inside
            del block.inside
            self.blocks.append(block)
            terms = terms[outside]
            by_term = np.argsort(terms, kind="stable")
            posting = (codes[outside].astype(kind) + kind(1)) << kind(self.bits) | (place[outside] + a).astype(kind)
            rest.append((terms[by_term], posting[by_term]))
            total += np.bincount(terms, minlength=n_terms)
        self.at = np.concatenate([[0], np.cumsum(total)])
        #: By term, the place in the lower bits and the code above.
        self.postings = np.empty(self.at[-1], kind)
        fill = self.at[:-1].copy()
        while rest:
            terms, posting = rest.pop(0)
            own = np.bincount(terms, minlength=n_terms)
            self.postings[np.arange(len(terms)) + np.repeat(fill - np.cumsum(own) + own, own)] = posting
            fill += own

    def rare(self, terms: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What postings of the terms add to the cosine of each place; q has idf in it."""
        first, n = self.at[terms], self.at[terms + 1] - self.at[terms]
        where = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        met = self.postings[where]
        kind = met.dtype.type
        parts = self.tf[met >> kind(self.bits)]
        parts *= np.repeat(q, n)
        return np.bincount(met & kind((1 << self.bits) - 1), parts, len(self.order)) * self.scale

    def search(self, queries: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> Iterator[tuple]:
        """For each query (terms, unit weights, those times idf) the rows that may be among the k + 1
        nearest, ascending, and their cosines in double precision."""
        n = len(queries)
        owner = np.repeat(np.arange(n), [len(t) for t, _, _ in queries])
        terms = np.concatenate([t for t, _, _ in queries])
        weights = np.concatenate([u for _, u, _ in queries]).astype(np.float32)
        rare = np.empty((n, len(self.order)))
        for row, (t, _, q) in zip(rare, queries, strict=True):
            row[:] = self.rare(t, q)
        score = rare.astype(np.float32)
        dense, bound = [], np.empty((n, len(self.blocks)), np.float32)
        for b, ((a, z), block) in enumerate(zip(self.spans, self.blocks, strict=True)):
            column = block.of(terms)
            inside = column >= 0
            d = np.zeros((n, len(block.matrix)), np.float32)
            d[owner[inside], column[inside]] = weights[inside]
            left = np.minimum(np.linalg.norm(d, axis=1)[:, None] * block.length, (d @ block.top)[:, None])
            left += score[:, a:z]
            bound[:, b] = left.max(axis=1)
            dense.append(d)
        best, bar = bound.argmax(axis=1), np.zeros(n, np.float32)
        for others in (False, True):
            for b, ((a, z), block) in enumerate(zip(self.spans, self.blocks, strict=True)):
                own = (best != b) if others else (best == b)
                reach = bound[:, b] >= bar - 2 * SLACK
                (who,) = np.nonzero(own & reach)
                score[own & ~reach, a:z] = -1
                if len(who):
                    score[who, a:z] += dense[b][who] @ block.matrix
                    if not others and z - a > k:
                        bar[who] = np.partition(score[who, a:z], z - a - k - 1, axis=1)[:, z - a - k - 1]
        for (t, _, q), exact, near, least in zip(queries, rare, score, bar, strict=True):
            (places,) = np.nonzero(near > max(least - 2 * SLACK, 0.0))
            if len(places) > k:
                near = near[places]
                places = places[near >= np.partition(near, -k - 1)[-k - 1] - 2 * SLACK]
            sims = exact[places]
            for b, (a, z) in enumerate(self.spans):
                lo, hi = np.searchsorted(places, (a, z))
                if lo < hi:
                    column = self.blocks[b].of(t)
                    (inside,) = np.nonzero(column >= 0)
                    codes = self.blocks[b].codes[(places[lo:hi] - a)[:, None], column[inside]]
                    # Each row's sum takes the same steps, whatever rows are beside it.
                    parts = self.tf[np.ascontiguousarray(codes)] * q[inside]
                    sims[lo:hi] += parts.sum(axis=1) * self.scale[places[lo:hi]]
            rows = self.order[places]
            order = np.argsort(rows)
            yield rows[order], sims[order]


class BlockMaxIndex:
    """Unit vectors of distinct examples, searched in blocks with each common term's largest weight."""

    def __init__(self, examples: list[tuple], idf: np.ndarray):
        examples = sorted(examples)
        self.idf = np.asarray(idf, np.float64)
        self.weight = np.array([[e[2], e[3]] for e in examples], np.float64).reshape(-1, 2)
        self.doc_id = [e[4] for e in examples]
        self.start = np.cumsum([0, *(len(e[0]) for e in examples)])
        # The few different counts are kept once.
        self.count = np.array(sorted(set().union(*(set(e[1]) for e in examples))), np.int64)
        self.tf = 1.0 + np.log(self.count.astype(np.float64))
        self.terms = np.empty(self.start[-1], np.int32)
        self.code = np.empty(self.start[-1], np.min_scalar_type(len(self.count)))
        self.norm = np.ones(len(examples))
        for row, (lo, hi) in enumerate(zip(self.start[:-1], self.start[1:], strict=True)):
            self.terms[lo:hi] = examples[row][0]
            self.code[lo:hi] = np.searchsorted(self.count, examples[row][1])
            self.norm[row] = np.linalg.norm(self.tf[self.code[lo:hi]] * self.idf[self.terms[lo:hi]])
            examples[row] = None
        size = np.diff(self.start)
        # Examples of one language and of like length share blocks, the same ones in every task.
        self.order = np.lexsort((size, self._alike(size)))
        self._tiles: _Tiles | None = None

    def _alike(self, size: np.ndarray) -> np.ndarray:
        """Numbers that examples of one language mostly share: on which side they lie along the
        first principal axes of the commonest terms. Speed only."""
        head = np.zeros((len(size), min(256, len(self.idf))), np.float32)
        inside = self.terms < head.shape[1]
        head[np.repeat(np.arange(len(size), dtype=np.int32), size)[inside], self.terms[inside]] = 1.0
        head /= np.maximum(np.linalg.norm(head, axis=1), 1e-9)[:, None]
        head -= head.sum(axis=0) / max(len(size), 1)
        _, axes = np.linalg.eigh(head.T @ head)
        side = head @ axes[:, -3:] > 0
        return side @ (1 << np.arange(side.shape[1]))

    def __getstate__(self):
        return self.__dict__ | {"_tiles": None}

    def tiles(self) -> _Tiles:
        if self._tiles is None:
            self._tiles = _Tiles(self)
        return self._tiles

    def example(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.start[row], self.start[row + 1]
        return self.terms[lo:hi], self.count[self.code[lo:hi]]

    def unit(self, terms, counts) -> np.ndarray:
        w = (1.0 + np.log(np.asarray(counts, np.float64))) * self.idf[np.asarray(terms, np.int64)]
        return w / np.linalg.norm(w) if len(w) else w

    def search(self, queries: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (terms, counts, less) the rows and cosines of the examples at least as
        near as the k-th; blocks whose bound is lower are skipped. ``less``, if not None, takes
        one vote of (row, label) away."""
        out = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        if not len(self.norm):
            return out
        tiles, every = self.tiles(), self.weight.sum(axis=1)
        for at in range(0, len(queries), QUERIES):
            part = queries[at : at + QUERIES]
            terms = [np.asarray(t, np.int64) for t, _, _ in part]
            units = [self.unit(t, c) for t, c, _ in part]
            asked = [(t, u, u * self.idf[t]) for t, u in zip(terms, units, strict=True)]
            # Every row but one that lost its only vote has a vote or more, so k + 1 rows hold k.
            for i, (rows, sims) in enumerate(tiles.search(asked, k)):
                if not len(rows):
                    continue
                less = part[i][2]
                order = np.lexsort((rows, -sims))
                weight = every[rows[order]]
                if less:
                    weight[rows[order] == less[0]] -= 1
                place = int(np.searchsorted(np.cumsum(weight), k))
                least = sims[order[place]] if place < len(order) else 0.0
                keep = (sims >= least - 1e-12) & (sims > 0)
                out[at + i] = rows[keep], sims[keep]
        return out

    def nearest(self, terms, counts, k: int, less: tuple[int, int] | None = None):
        return self.search([(terms, counts, less)], k)[0]

    def votes(self, queries: list[tuple]) -> list[tuple[float, list[int]]]:
        """Similarity-weighted toxic share of the nearest examples of each query, and some of
        their doc_ids; the share is NaN where no example has a term of the query."""
        out = []
        for (_, _, less), (rows, sims) in zip(queries, self.search(queries, NEIGHBOURS), strict=True):
            w = self.weight[rows].copy()
            if less:
                w[rows == less[0], less[1]] -= 1
            mass = sims @ w
            total = mass.sum()
            order = np.lexsort((rows, -sims))[:5]
            share = float(mass[1] / total) if total > 0 else float("nan")
            out.append((share, [self.doc_id[r] for r in rows[order]]))
        return out


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours: knots and values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # x, weighted mean, weight
    for i in order:
        pools.append([float(x[i]), float(y[i]), float(w[i])])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            b, a = pools.pop(), pools.pop()
            total = a[2] + b[2]
            pools.append([b[0], (a[1] * a[2] + b[1] * b[2]) / total, total])
    return np.array([p[0] for p in pools]), np.array([p[1] for p in pools])


class ToxicityModel:
    """Calibration curve, and the scores of texts without any word or any term of an example.

    ``bare`` has the clean and toxic rows of examples without words; ``cast`` the share, label
    and rows of each example's vote without itself.
    """

    def __init__(self, rows: tuple[int, int], bare: tuple[int, int], cast: list[tuple[float, int, float]]):
        clean, toxic = rows
        self.prior = (toxic + 0.5) / (clean + toxic + 1.0) if clean + toxic else 0.0
        self.without = (bare[1] + self.prior) / (sum(bare) + 1.0)
        votes, labels, weights = zip(*cast, strict=True) if cast else ((), (), ())
        # Two weak points keep the curve inside (0, 1) and defined on little data.
        x = np.array([*votes, 0.0, 1.0])
        y, w = np.array([*labels, self.prior, 0.5 + self.prior / 2]), np.array([*weights, 1.0, 1.0])
        self.knots, self.values = monotone(x, y, w)

    def score(self, share: float, bare: bool) -> float:
        if bare:
            return self.without
        if share != share:
            return self.prior
        return float(np.clip(np.interp(share, self.knots, self.values), 0.0, 1.0))


def _votes_without_self(spark: SparkSession, index: BlockMaxIndex, shared) -> list[tuple[float, int, float]]:
    """(share, label, rows) of each label of each example, its own vote taken away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            asked = [(r, label) for r in batch.column(0).to_pylist() for label in (0, 1) if own.weight[r, label]]
            shares = [s for s, _ in own.votes([(*own.example(r), (r, label)) for r, label in asked])]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([a[i] for a in asked], pa.int64()) for i in (0, 1)), pa.array(shares, pa.float64())],
                ["row", "label", "share"],
            )

    rows = spark.range(0, len(index.norm), 1, partitions(spark))
    cast = rows.mapInArrow(run, "row long, label long, share double").toArrow()
    cast = cast.sort_by([("row", "ascending"), ("label", "ascending")])
    found = zip(*(cast.column(c).to_pylist() for c in ("row", "label", "share")), strict=True)
    return [(s, label, float(index.weight[r, label])) for r, label, s in found if s == s]


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, th) of every row of docs (doc_id, text).

    Only the text decides a score. NULL text is empty and scores as examples without any word
    do; a text no example shares a term with has the share of toxic examples; equal texts score
    alike; without labels the score is 0. ``evidence`` lists doc_ids of the nearest examples,
    ``th`` is a hash of the text. Fitting holds at most MAX_EXAMPLES labelled rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    examples = stored(choose_examples(labels), "toxicity-examples")
    terms = example_terms(docs, examples)
    vectors, n_terms = term_vectors(docs, terms), len(terms)
    del terms
    idf = np.log((1 + vectors.count()) / (1 + document_frequency(vectors, n_terms))) + 1.0
    # Equal example vectors are one entry with the number of clean and toxic rows.
    chosen = stored(
        vectors.join(F.broadcast(examples), "doc_id")
        .groupBy("terms", "counts")
        .agg(
            F.sum(1 - F.col("toxic")).alias("clean"),
            F.sum("toxic").alias("toxic"),
            F.min("doc_id").alias("doc_id"),
        ),
        "toxicity-chosen",
    )
    rows, bare, some = np.zeros(2, np.int64), np.zeros(2, np.int64), []
    # The driver takes one part at a time and keeps arrays, which compare like tuples.
    for t, c, *n, doc_id in chosen.toLocalIterator():
        rows += n
        found, times = _terms_of(bytes(t)), _unpacked(bytes(c))
        if len(found):
            small = np.min_scalar_type(times.max()).char
            some.append((array("i", found.astype(np.int32).tobytes()), array(small, times.astype(small).tobytes()), *n, doc_id))
        else:
            bare += n
    index = BlockMaxIndex(some, idf)
    del some
    shared = spark.sparkContext.broadcast(index)
    model = ToxicityModel(tuple(rows.tolist()), tuple(bare.tolist()), _votes_without_self(spark, index, shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, list[int]]] = {}
        for batch in batches:
            vectors = list(zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True))
            keys = [hashlib.md5(b"%d %b%b" % (len(t), t, c)).digest() + bytes([bare]) for t, c, bare in vectors]
            if len(known) > 50_000:
                known.clear()
            fresh = {key: v for key, v in zip(keys, vectors, strict=True) if key not in known}
            votes = shared.value.votes([(_terms_of(t), _unpacked(c), None) for t, c, _ in fresh.values()])
            for (key, (_, _, bare)), (share, evidence) in zip(fresh.items(), votes, strict=True):
                known[key] = (model.score(share, bare), evidence)
            out = [known[key] for key in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([s for s, _ in out], pa.float64()),
                    pa.array([e for _, e in out], pa.list_(pa.int64())),
                ],
                ["doc_id", "th", "score", "evidence"],
            )

    scored = vectors.mapInArrow(run, "doc_id long, th long, score double, evidence array<long>")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
        "th",
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that are not predicted toxic, rows without a doc_id included."""
    rejected = score_toxicity(docs, labels).where("predicted = 1").select(
        F.col("doc_id").alias("toxic_id"), F.col("th").alias("toxic_th")
    )
    same = docs["doc_id"].eqNullSafe(F.col("toxic_id")) & (F.xxhash64(whole_text()) == F.col("toxic_th"))
    return docs.join(rejected, same, "left_anti")
