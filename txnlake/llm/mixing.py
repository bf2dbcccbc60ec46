"""Mixing sources to target weights by blocks of words.

The words of a source, its documents in doc_id order, are cut into blocks of fixed length. The
mix is a sequence of block slots in shards. How many slots of a shard go to each source is a
multinomial draw conditioned on the totals of the mix, made by halving the range of shards again
and again, so that any task finds the counts of its shards by itself. Slot i of a source holds
block ``perm(i mod n)`` of its n blocks, with a pseudorandom permutation for each round through
them, and blocks are joined by index.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlake.llm.common import partitions, stored, whole_text

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, slots of a shard, and how often a source may be repeated.
BLOCK_WORDS = 64
SHARD_SLOTS = 8192
MOST_REPEATS = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: dict[str | None, int], most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Targets by weight 1, 2, 3, repeating, over sources in code point order, NULL last.

    They share the sum of all sizes; one above ``most`` times its size stops there, and the
    excess goes to the others by weight until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = left / sum(weight[s] for s in free) if free else 0.0
        above = {s for s in free if share * weight[s] > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in capped else share * weight[s] for s in order}
        capped |= above


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: four Feistel rounds, walked until back in range."""
    half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = i.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> half, x[todo] & mask
        for r in range(4):
            turn = _mixed(right + np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 % (1 << 64)))
            left, right = right, left ^ (turn & mask)
        x[todo] = (left << half) | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


#: The library draws from fewer slots than this; from there on the same distribution is drawn here.
LIBRARY_SLOTS = 1_000_000_000
#: So few marked or drawn slots are drawn one after another.
ONE_BY_ONE = 1000


def _log_growth(x: int, d: int) -> float:
    """``log((x + d)! / x!) - d * log(max(x, 1))`` without the rounding of huge log factorials."""
    if min(x, x + d) < 1_000_000:
        return math.lgamma(x + d + 1) - math.lgamma(x + 1) - d * math.log(max(x, 1))
    u = d / x
    # (1 + u) * log(1 + u) - u, by its series where the difference would lose digits.
    small = u * u * (1 / 2 - u * (1 / 6 - u * (1 / 12 - u / 20)))
    bent = small if abs(u) < 1e-3 else (1 + u) * math.log1p(u) - u
    return x * bent + math.log1p(u) / 2 - d / (12 * x * (x + d))


def _by_ratio(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric number by ratio of uniforms (Stadlober): exact but for double rounding."""
    total = good + bad
    mean = sample * good / total
    variance = mean * (bad / total) * ((total - sample) / (total - 1))
    wide = 2 * math.sqrt(2 / math.e) * math.sqrt(variance + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    mode = (sample + 1) * (good + 1) // (total + 2)
    # The four counts at the mode, and which way each goes when the drawn number grows.
    at = ((mode, 1), (good - mode, -1), (sample - mode, -1), (bad - sample + mode, 1))
    up = max(good - mode, 1) * max(sample - mode, 1)
    down = max(mode, 1) * max(bad - sample + mode, 1)
    slope = math.log1p((up - down) / down)
    while True:
        x, y = 1.0 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + wide * (y - 0.5) / x)
        if not max(0, sample - bad) <= k <= min(good, sample):
            continue
        d = k - mode
        if 2 * math.log(x) <= d * slope - sum(_log_growth(c, way * d) for c, way in at):
            return k


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` slots drawn without return from ``good + bad`` are good, at any size."""
    total = good + bad
    if total < LIBRARY_SLOTS:
        return int(rng.hypergeometric(good, bad, sample))
    if 2 * sample > total:
        return good - hypergeometric(rng, good, bad, total - sample)
    if good > bad:
        return sample - hypergeometric(rng, bad, good, sample)
    few, many = min(good, sample), max(good, sample)
    if few < ONE_BY_ONE:
        # Good and drawn slots may change places: each of the few falls on one of the many or not.
        hit = 0
        for i in range(few):
            hit += rng.integers(total - i) < many - hit
        return hit
    return _by_ratio(rng, good, bad, sample)


def _draw(rng: np.random.Generator, colors: np.ndarray, sample: int) -> np.ndarray:
    """How many of ``sample`` slots drawn without return have each source."""
    if colors.sum() < LIBRARY_SLOTS:
        return rng.multivariate_hypergeometric(colors, sample, method="marginals")
    out, left, rest = np.zeros_like(colors), int(sample), int(colors.sum())
    for i, c in enumerate(colors.tolist()):
        out[i] = hypergeometric(rng, c, rest - c, left)
        left, rest = left - int(out[i]), rest - c
    return out


def shard_counts(shard: int, slots: np.ndarray, seed: int, memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in this shard, and in all shards before it."""
    total = int(slots.sum())
    low, high = 0, -(-total // SHARD_SLOTS)
    counts, before = slots.astype(np.int64), np.zeros(len(slots), np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        if (low, high) not in memo:
            in_left = min(mid * SHARD_SLOTS, total) - low * SHARD_SLOTS
            memo[low, high] = _draw(np.random.default_rng([seed, low, high]), counts, in_left)
        left = memo[low, high]
        if shard < mid:
            high, counts = mid, left
        else:
            low, counts, before = mid, counts - left, before + left
    return counts, before


def placed_documents(docs: DataFrame, sources: dict[str | None, int], *more: str) -> DataFrame:
    """Stored rows (part, row, src, doc_id, size, begin, *more): begin counts the words of the
    source before the document. Equal doc_ids are ordered by a hash of their text."""
    spark = docs.sparkSession
    listed = spark.createDataFrame([(s, i) for s, i in sources.items()], "source string, src int")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(whole_text()).alias("size"),
        F.xxhash64(whole_text()).alias("tie"), *more,
    )
    known = sized.join(
        F.broadcast(listed) if len(sources) < 10_000 else listed,
        sized["source"].eqNullSafe(listed["source"]),
    ).select("src", "doc_id", "tie", "size", *more)
    order = ["src", "doc_id", "tie"]
    dealt = known.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, sums = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            frame = batch.select(["src", "size"]).to_pandas()
            begin = frame.groupby("src")["size"].cumsum() - frame["size"]
            begin += frame["src"].map(sums).fillna(0).astype("int64")
            for s, n in frame.groupby("src")["size"].sum().items():
                sums[s] = sums.get(s, 0) + n
            n = len(frame)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(row, row + n, dtype=np.int64)),
                    *(batch.column(c) for c in ("src", "doc_id", "size")),
                    pa.array(begin.to_numpy(np.int64)),
                    *(batch.column(c) for c in more),
                ],
                ["part", "row", "src", "doc_id", "size", "begin", *more],
            )
            row += n

    types = dict(known.dtypes)
    extra = "".join(f", `{c}` {types[c]}" for c in more)
    rows = stored(
        dealt.mapInArrow(
            run, "part int, row long, src int, doc_id long, size long, begin long" + extra
        ),
        "mix-documents",
    )
    by_part = rows.groupBy("src", "part").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(W.partitionBy("src").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    firsts = by_part.select("src", "part", F.coalesce(before, F.lit(0)).alias("first"))
    return rows.join(firsts, ["src", "part"]).select(
        "part", "row", "src", "doc_id", "size", (F.col("begin") + F.col("first")).alias("begin"), *more
    )


def mix_slots(spark, blocks: list[int], slots: list[int], seed: int) -> DataFrame:
    """The mix: (shard, place, src, block), a row for each slot.

    Shards are drawn by themselves; the place within a shard is a permutation of its slots.
    """
    n_slots = np.array(slots, np.int64)
    n_shards = -(-int(n_slots.sum()) // SHARD_SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts, before = shard_counts(shard, n_slots, seed, memo)
                src = np.repeat(np.arange(len(counts)), counts)
                block = np.empty(len(src), np.int64)
                at = 0
                for s, (c, b) in enumerate(zip(counts.tolist(), before.tolist(), strict=True)):
                    i = np.arange(b, b + c)
                    for turn in np.unique(i // blocks[s]) if c else ():
                        own = i // blocks[s] == turn
                        key = (seed * 1_000_003 + s) * 16 + int(turn)
                        block[at : at + c][own] = permute(i[own] % blocks[s], blocks[s], key)
                    at += c
                place = permute(np.arange(len(src)), max(len(src), 1), seed * 31 + shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(src), shard, np.int64)),
                        pa.array(place),
                        pa.array(src.astype(np.int32)),
                        pa.array(block),
                    ],
                    ["shard", "place", "src", "block"],
                )

    shards = spark.range(0, n_shards, 1, max(1, min(n_shards, partitions(spark))))
    return shards.mapInArrow(run, "shard long, place long, src int, block long")


def mix(docs: DataFrame, *more: str, seed: int = 17) -> DataFrame:
    """Every document with what the mix takes of it.

    (part, row, doc_id, size, source_size, target, taken, pieces, *more): (part, row) names the
    row, ``pieces`` lists (first, words, times) within the document, one for each block that
    touches it. NULL or empty text has size 0 and is taken 0 times; repeated rows are documents
    of their own; NULL is a source of its own. A source gives whole blocks, so what is taken
    differs from its target by less than one block for each time its last, short block is used.
    The list of sources, one number each, is the only thing the driver holds.
    """
    spark = docs.sparkSession
    totals = docs.groupBy("source").agg(F.sum(n_words(whole_text())).alias("n"))
    sizes = {r["source"]: r["n"] for r in totals.collect()}
    targets = source_targets(sizes)
    order = list(targets)
    src = {s: i for i, s in enumerate(order)}
    blocks = [-(-sizes[s] // BLOCK_WORDS) for s in order]
    slots = [
        min(round(targets[s] * blocks[src[s]] / sizes[s]) if sizes[s] else 0, MOST_REPEATS * blocks[src[s]])
        for s in order
    ]
    placed = placed_documents(docs, src, *more)
    takes = mix_slots(spark, blocks, slots, seed).groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    last = F.floor((F.col("begin") + F.col("size") - 1) / BLOCK_WORDS)
    touched = F.when(
        F.col("size") > 0, F.sequence(F.floor(F.col("begin") / BLOCK_WORDS), last)
    )
    parts = placed.where("size > 0").select(
        "part", "row", "src", "begin", "size", F.explode(touched).alias("block")
    )
    first = F.greatest(F.col("block") * BLOCK_WORDS - F.col("begin"), F.lit(0))
    end = F.least((F.col("block") + 1) * BLOCK_WORDS - F.col("begin"), F.col("size"))
    taken = (
        # The planner takes the slots for as few as their shards and would broadcast them.
        parts.join(takes.hint("merge"), ["src", "block"])
        .groupBy("part", "row")
        .agg(
            F.sum((end - first) * F.col("times")).alias("taken"),
            F.collect_list(F.struct(first.alias("first"), (end - first).alias("words"), "times")).alias("pieces"),
        )
    )
    facts = spark.createDataFrame(
        [(src[s], s, int(sizes[s]), targets[s]) for s in order],
        "src int, source string, source_size long, target double",
    )
    return placed.join(taken.hint("merge"), ["part", "row"], "left").join(
        F.broadcast(facts) if len(order) < 10_000 else facts, "src"
    ).select(
        "part", "row", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "pieces", *more,
    )


_SPAN = re.compile(WORD)


def taken_texts(text: str, pieces: list[tuple[int, int, int]]) -> list[str]:
    """The copies of a text that the mix holds: copy c has the blocks taken at least c times."""
    out = []
    pieces = sorted(pieces)
    size = sum(w for _, w, _ in pieces)
    spans = None
    for copy in range(1, max((t for *_, t in pieces), default=0) + 1):
        kept = [(f, f + w) for f, w, t in pieces if t >= copy]
        words = sum(e - f for f, e in kept)
        spans = spans or [m.span() for m in _SPAN.finditer(text)]
        if words == len(spans) == size:
            out.append(text)
            continue
        runs: list[list[int]] = []
        for f, e in kept:
            if runs and runs[-1][1] == f:
                runs[-1][1] = e
            else:
                runs.append([f, e])
        out.append("\n".join(text[spans[f][0] : spans[e - 1][1]] for f, e in runs))
    return out


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents (doc_id, text, lang, source, n_chars): a row for each copy.

    A document that the mix does not take is absent; one taken twice has two rows.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    mixed = mix(docs.select(*columns), "text", "lang").where("taken > 0")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                pieces = [(p["first"], p["words"], p["times"]) for p in r.pieces]
                for text in taken_texts(r.text, pieces):
                    rows.append((r.doc_id, text, r.lang, r.source, len(text)))
            yield pd.DataFrame(rows, columns=columns).astype({"n_chars": "int64"})

    return mixed.select("doc_id", "text", "lang", "source", "pieces").mapInPandas(
        run, "doc_id long, text string, lang string, source string, n_chars long"
    )
