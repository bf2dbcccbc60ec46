"""Near-duplicates by ProbMinHash over weighted word shingles, banding and exact verification.

Shingles are runs of five words (lower-cased, separated by ASCII white space), weighted by how
often they occur; two texts are near-duplicates when their probability Jaccard similarity is at
least 0.8. Each shingle is a Poisson process of its weight whose arrivals fall on random
registers; a register keeps its first arrival, and a shingle stops as soon as its next arrival
comes later than all registers. Texts that agree in all registers of a band share a bucket.

Exact copies are one node. Each bucket's hub is compared with its other members first, which
links most of what belongs together. In buckets that still hold several classes, the members
outside the largest class then meet all others in blocks of bounded size; a pair is compared in
the first bucket it shares, and only until its classes are linked. No bucket is ever gathered,
and no pairs are written but those of hubs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import partitions, stored, whole_text
from txnlake.llm.rolling import Rolling, scramble

WORDS = 5
SIMILARITY = 0.8
REGISTERS = 128
BANDS = 32
#: Members of a side of a block, about.
BLOCK = 512
#: Agreeing registers below which a pair is not verified: five standard deviations under 0.8.
LEAST_AGREEING = int(REGISTERS * SIMILARITY - 5 * (REGISTERS * SIMILARITY * (1 - SIMILARITY)) ** 0.5)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts. A text of fewer than five words is
    one shingle; a text without words has none."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    words = Rolling(data).of(starts, ends)
    take = min(WORDS, len(words))
    n = len(words) - take + 1
    mixed = np.full(n, take, np.uint64)
    for i in range(take):
        mixed = scramble(mixed * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return np.unique(mixed, return_counts=True)


def signature(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The element that arrives first at each register, as 32-bit values."""
    first = np.full(REGISTERS, np.inf)
    element = np.zeros(REGISTERS, np.uint64)
    ids, weight = hashes, counts.astype(np.float64)
    clock, arrival = np.zeros(len(ids)), np.zeros(len(ids), np.uint64)
    while len(ids):
        # Few shingles make several arrivals a step, so that steps stay few.
        steps = max(1, 512 // len(ids))
        order = arrival[:, None] + np.arange(1, steps + 1, dtype=np.uint64)
        draw = scramble(ids[:, None] + order * np.uint64(0xD1342543DE82EF95))
        unit = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        times = clock[:, None] + np.cumsum(-np.log(unit), axis=1) / weight[:, None]
        register = (scramble(draw) % np.uint64(REGISTERS)).astype(np.int64)
        flat, at = times.ravel(), register.ravel()
        better = np.flatnonzero(flat < first[at])
        late_first = better[np.argsort(-flat[better], kind="stable")]
        # Assignments run in order, so the earliest arrival of a register is written last.
        first[at[late_first]] = flat[late_first]
        element[at[late_first]] = ids[late_first // steps]
        clock, arrival = times[:, -1], arrival + np.uint64(steps)
        going = clock < first.max()
        ids, weight, clock, arrival = ids[going], weight[going], clock[going], arrival[going]
    return (scramble(element) >> np.uint64(32)).astype(np.uint32)


def prob_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (distinct hashes, weights)."""
    if not len(a) or not len(b):
        return 0.0
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if wa.max() == wa.min() and wb.max() == wb.min():
        # One weight in each text: plain Jaccard, since the measure does not see scale.
        return len(common) / (len(a) + len(b) - len(common))
    if not len(common):
        return 0.0
    every = np.union1d(a, b)
    full_a, full_b = np.zeros(len(every)), np.zeros(len(every))
    full_a[np.searchsorted(every, a)] = wa
    full_b[np.searchsorted(every, b)] = wb
    with np.errstate(divide="ignore"):
        ratio = full_a / full_b
    order = np.argsort(ratio, kind="stable")
    # Below a shingle's own ratio b's weights count, from it on a's.
    below = np.concatenate([[0.0], np.cumsum(full_b[order])])
    above = np.concatenate([np.cumsum(full_a[order][::-1])[::-1], [0.0]])
    xa, xb = wa[ia].astype(float), wb[ib].astype(float)
    at = np.searchsorted(ratio[order], xa / xb)
    return float((1.0 / (above[at] / xa + below[at] / xb)).sum())


def _nodes(docs: DataFrame) -> DataFrame:
    """Stored distinct texts: (node, hash, doc_id of one row, sig)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            sigs = []
            for digest, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if digest in seen:
                    sigs.append(None)
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(digest)
                hashes, counts = shingles(text)
                sigs.append(signature(hashes, counts).view(np.int32) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sigs, pa.list_(pa.int32()))],
                ["doc_id", "hash", "sig"],
            )

    signed = _hashed(docs).mapInArrow(run, "doc_id long, hash string, sig array<int>")
    once = signed.groupBy("hash").agg(
        F.min("doc_id").alias("doc_id"), F.first("sig", ignorenulls=True).alias("sig")
    )
    return stored(once.withColumn("node", F.monotonically_increasing_id()), "near-nodes")


def _hashed(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("hash"), text.alias("text"))


def _buckets(nodes: DataFrame) -> DataFrame:
    """Stored (key, band, node, hub) of buckets with at least two nodes; the hub is the least node."""
    rows = REGISTERS // BANDS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.slice("sig", b * rows + 1, rows)),
    )
    bands = nodes.where("sig IS NOT NULL").select("node", F.posexplode(keys).alias("band", "key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
    return stored(bands.join(shared.hint("merge"), "key").select("key", "band", "node", "hub"), "near-buckets")


def _shingle_table(docs: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """Stored (node, sig, hashes, counts) of the nodes in buckets: whole 64-bit hashes, ascending;
    counts are empty if all are one."""
    inside = nodes.join(buckets.select("node").distinct(), "node", "left_semi")
    needed = inside.select("node", "hash", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = [], []
            for text in batch.column(1).to_pylist():
                h, c = shingles(text)
                hashes.append(h.tobytes())
                counts.append(b"" if (c == 1).all() else c.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())],
                ["node", "hashes", "counts"],
            )

    rows, needed = _hashed(docs), needed.withColumnsRenamed({"hash": "node_hash", "doc_id": "node_id"})
    # A text that only rows without a doc_id have is found by them.
    same = rows["doc_id"].eqNullSafe(needed["node_id"]) & (rows["hash"] == needed["node_hash"])
    texts = rows.join(needed, same).select("node", "text")
    made = texts.mapInArrow(run, "node long, hashes binary, counts binary")
    once = made.groupBy("node").agg(F.first("hashes").alias("hashes"), F.first("counts").alias("counts"))
    return stored(once.join(inside.select("node", "sig"), "node"), "near-shingles")


def _weighted(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(hashes, np.uint64)
    return h, np.frombuffer(counts, np.uint32) if counts else np.ones(len(h), np.uint32)


def _verified(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Stored links among pairs (a, b): those whose similarity is at least SIMILARITY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            keep = pa.array(
                [prob_jaccard(*_weighted(ha, ca), *_weighted(hb, cb)) >= SIMILARITY for ha, ca, hb, cb in rows],
                pa.bool_(),
            )
            yield batch.select([0, 1]).filter(keep)

    of = lambda c: table.select(
        F.col("node").alias(c), F.col("hashes").alias(f"h{c}"), F.col("counts").alias(f"c{c}")
    )
    full = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ha", "ca", "hb", "cb")
    return stored(full.mapInArrow(run, "a long, b long"), "near-links")


def _block_links(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links between the outer rows and the others of one block, as few as connect the classes.

    Rows are (key, band, comp, outer, node, sig, hashes, counts).
    """
    band, rows_a_band = rows[0][1], REGISTERS // BANDS
    outer, inner = [r for r in rows if r[3]], [r for r in rows if not r[3]]
    if not outer or not inner:
        return []
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    sigs = np.array([r[5] for r in inner], np.int32)
    comps = np.array([r[2] for r in inner])
    out = []
    for o in outer:
        agree = sigs == np.array(o[5], np.int32)
        first = agree.reshape(len(inner), BANDS, rows_a_band).all(axis=2).argmax(axis=1)
        likely = (agree.sum(axis=1) >= LEAST_AGREEING) & (first == band) & (comps != o[2])
        for i in np.flatnonzero(likely):
            x = inner[i]
            if find(o[2]) != find(x[2]) and prob_jaccard(*_weighted(*o[6:8]), *_weighted(*x[6:8])) >= SIMILARITY:
                root[find(o[2])] = find(x[2])
                out.append((max(o[4], x[4]), min(o[4], x[4])))
    return out


def _blocks(members: DataFrame, table: DataFrame) -> DataFrame:
    """Stored links of members (key, band, node, comp) of buckets that hold several classes."""
    by_class = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    by_key = by_class.groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"),
        F.sum("n").alias("all"),
        (F.sum("n") - F.max("n")).alias("few"),
    ).where("few > 0")
    ceil = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    sized = members.join(by_key.hint("merge"), "key").select(
        "key", "band", "node", "comp", (F.col("comp") != F.col("main")).alias("outside"),
        ceil("all").alias("columns"), ceil("few").alias("rows"),
    )
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "band", "comp", "node", "outer", "x", "y"]
    inner = sized.withColumn("x", at("columns")).withColumn("y", every("rows")).withColumn("outer", F.lit(False))
    outer = sized.where("outside").withColumn("y", at("rows")).withColumn("x", every("columns"))
    placed = inner.select(*columns).unionByName(outer.withColumn("outer", F.lit(True)).select(*columns))
    full = placed.join(table.hint("merge"), "node").select(
        "key", "x", "y", "band", "comp", "outer", "node", "sig", "hashes", "counts"
    )
    n = partitions(members.sparkSession)
    dealt = full.repartition(n, "key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = [], None

        def links() -> pa.RecordBatch:
            found = _block_links(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in range(2)], ["a", "b"]
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(10)), strict=True):
                if row[:3] != block:
                    if held:
                        yield links()
                    held, block = [], row[:3]
                held.append((row[0], *row[3:]))
        if held:
            yield links()

    return stored(dealt.mapInArrow(run, "a long, b long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """Stored (a, b): each linked node except the smallest of its class, and that smallest node.

    Alternating stars: every node points its larger neighbours, then all its neighbours, at the
    smallest one, until nothing changes. Only minima per node are grouped, never lists.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
        "near-stars",
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "near-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges
        mark = now


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose registers agree often enough to be verified, with how often they do."""
    of = lambda c: nodes.select(F.col("node").alias(c), F.col("sig").alias(f"s{c}"))
    same = F.aggregate(
        F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    return (
        pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", same.alias("same"))
        .where(F.col("same") >= LEAST_AGREEING)
    )


def _classes(docs: DataFrame) -> DataFrame:
    """(hash, comp, doc_id) of each distinct text: its class, and the least doc_id of its rows."""
    nodes = _nodes(docs)
    buckets = _buckets(nodes)
    pairs = buckets.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    likely = stored(_agreeing(pairs, nodes), "near-pairs")
    table = _shingle_table(docs, nodes, buckets)
    links = _verified(likely.select("a", "b"), table)
    stars = components(links)
    members = _labelled(buckets.select("key", "band", "node"), stars)
    more = _blocks(members, table)
    if not more.isEmpty():
        stars = components(links.unionByName(more))
    return _labelled(nodes.select("hash", "node", "doc_id"), stars).select("hash", "comp", "doc_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_text): the class of each row of docs (doc_id, text).

    Classes are the connected components of the links. ``class_id`` is the least doc_id of the
    class, NULL if none of its rows has one; ``class_text`` is the least MD5 of its texts and
    tells classes apart that share a doc_id or have none. NULL text is empty; texts without words
    are near only to their exact copies; repeated rows are copies. An empty table gives no rows.
    """
    named = _classes(docs)
    least = named.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.min("hash").alias("class_text"))
    classes = named.join(least, "comp").select("hash", "class_id", "class_text")
    rows = _hashed(docs).select("doc_id", "hash").join(classes, "hash")
    return rows.select("doc_id", "class_id", "class_text")


def _labelled(rows: DataFrame, stars: DataFrame) -> DataFrame:
    """Rows with the class (comp) of their node: the node itself where nothing is linked."""
    label = stars.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return rows.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class: that of the least doc_id, those without one last, then by hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "hash")).alias("first")
    kept = _classes(docs).groupBy("comp").agg(first).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.hash").alias("kept_hash")
    )
    row_id, row_hash = docs["doc_id"].cast("long"), F.md5(whole_text())
    rows = docs.join(kept, row_id.eqNullSafe(F.col("kept_id")) & (row_hash == F.col("kept_hash")), "left_semi")
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("d")).first()
    if ids["n"] == ids["d"]:
        return rows
    # Rows that say the same (doc_id, text) again.
    return rows.withColumn("_kept_hash", row_hash).dropDuplicates(["doc_id", "_kept_hash"]).drop("_kept_hash")
