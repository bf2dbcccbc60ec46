"""Exact removal of repeated byte strings with suffix arrays over shards.

A string of ``length`` bytes that starts at two places of the corpus is found in four steps.

1. Every window of ``length`` bytes is assigned to an anchor, the window's substring of ANCHOR
   bytes with the least hash (the leftmost of equals). Equal windows choose equal anchors at the
   same offset, so only windows whose anchors recur can be repeated. The windows of one anchor
   place are consecutive; the bytes they span are its segment.
2. Segments that occur twice or more as a whole are repeated in full, whatever their number.
3. Of anchors with several different segments, one copy of each goes to a shard by anchor. Shards
   are sorted by external induced sorting (``induced_sort``), and windows whose neighbours in
   suffix order share ``length`` bytes are repeated. Anchors with more than HOT different
   segments are divided first: pieces of STEP window offsets are dealt by the bytes that all
   their windows share, and go through the same steps. Where even these bytes have more than
   HOT different pieces, single windows are counted by a 128-bit fingerprint.
4. Repeated windows go back to their documents as byte ranges, which are cut out together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import partitions, stored, whole_text
from txnlake.llm.induced_sort import repeated
from txnlake.llm.rolling import Rolling, scramble

LENGTH = 200
ANCHOR = 64
HOT = 256
STEP = 16
_PLACE = np.uint64((1 << 36) - 1)


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive hashes."""
    n = len(hashes) - width + 1
    padded = np.full(-(-len(hashes) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, first window, number of windows, place of the anchor after
    the first window's start) of each anchor place.

    Places compare by the upper bits of their hash, then by position: the leftmost of equals.
    """
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    rolling = Rolling(data)
    hashes = rolling.windows(anchor)
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = _least(ranked, length - anchor + 1) & _PLACE
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    count = np.diff(np.append(first, len(least)))
    whole = rolling.of(first, first + count - 1 + length)
    at = least[first].astype(np.int64)
    return hashes[at].view(np.int64), whole.view(np.int64), first, count, at - first


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): a row is known by its id and a hash of its text; rows equal in both
    are true copies, and get equal results."""
    text = whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _places(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(anchor, seg, doc_id, th, first, windows, at): a row for each anchor place."""
    names = ["anchor", "seg", "doc_id", "th", "first", "windows", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            found = [
                segments(np.frombuffer(t.encode(), np.uint8), length, anchor)
                for t in batch.column(2).to_pylist()
            ]
            row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            if not len(row):
                continue
            a, s, f, n, at = (np.concatenate([x[i] for x in found]) for i in range(5))
            take = pa.array(row)
            columns = [pa.array(a), pa.array(s), ids.take(take), hashes.take(take)]
            columns += [pa.array(x.astype(np.int32)) for x in (f, n, at)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _texts(docs).mapInArrow(
        run, "anchor long, seg long, doc_id long, th long, first int, windows int, at int"
    )


def _cut_segments(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Stored (anchor, seg, hot, at, bytes) of wanted (anchor, seg, hot, place)."""
    lists = wanted.groupBy("place.doc_id", "place.th").agg(
        F.collect_list(
            F.struct("anchor", "seg", "hot", "place.at", "place.first", "place.windows")
        ).alias("cuts")
    )
    texts = _texts(docs)
    # Rows equal in id and hash repeat the same cuts; one of them is enough.
    joined = texts.join(
        lists, texts["doc_id"].eqNullSafe(lists["doc_id"]) & (texts["th"] == lists["th"])
    ).select("text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode()
                own = [data[c["first"] : c["first"] + c["windows"] - 1 + length] for c in cuts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[k] for c in cuts]) for k in ("anchor", "seg", "hot")]
                    + [pa.array([c["at"] for c in cuts], pa.int32()), pa.array(own, pa.binary())],
                    ["anchor", "seg", "hot", "at", "bytes"],
                )

    made = joined.mapInArrow(run, "anchor long, seg long, hot boolean, at int, bytes binary")
    return stored(made, "suffix-segments")


_RUNS = "anchor long, seg long, start int, end int"


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _sorted_shards(cut: DataFrame, length: int) -> DataFrame:
    """Repeated windows (anchor, seg, start, end) of segments, sorted in one shard a partition."""
    dealt = cut.select("anchor", "seg", "bytes").repartition(partitions(cut.sparkSession), "anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, segs, texts, seen = [], [], [], set()
        for batch in batches:
            for a, s, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (a, s) not in seen:
                    seen.add((a, s))
                    anchors.append(a)
                    segs.append(s)
                    texts.append(b)
        if not texts:
            return
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        # Symbol 0 ends a segment; bytes are the symbols after it.
        text = np.zeros(int((sizes + 1).sum()), np.int16)
        at = np.ones(len(text), bool)
        at[starts + sizes] = False
        text[at] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
        del texts
        begins = np.zeros(len(text) + 1, np.int8)
        begins[starts] = 1
        begins[starts + sizes - length + 1] = -1
        found = repeated(text, np.cumsum(begins[:-1]).astype(bool), length)
        low, high = _runs(found)
        k = np.searchsorted(starts, low, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(anchors, np.int64)[k]),
                pa.array(np.array(segs, np.int64)[k]),
                pa.array((low - starts[k]).astype(np.int32)),
                pa.array((high - starts[k]).astype(np.int32)),
            ],
            ["anchor", "seg", "start", "end"],
        )

    return dealt.mapInArrow(run, _RUNS)


def _counted_windows(cut: DataFrame, length: int) -> DataFrame:
    """Repeated windows of hot anchors: each window by itself, dealt by its own content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, s, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = np.frombuffer(b, np.uint8)
                one, two = Rolling(data).windows(length), Rolling(data[::-1]).windows(length)[::-1]
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array(np.ascontiguousarray(two).view(np.int64)),
                        pa.array(np.full(n, a, np.int64)),
                        pa.array(np.full(n, s, np.int64)),
                        pa.array(np.arange(n, dtype=np.int32)),
                    ],
                    ["one", "two", "anchor", "seg", "start"],
                )

    once = cut.select("anchor", "seg", "bytes").dropDuplicates(["anchor", "seg"])
    windows = once.mapInArrow(run, "one long, two long, anchor long, seg long, start int")
    often = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(often.hint("merge"), ["one", "two"]).select(
        "anchor", "seg", "start", (F.col("start") + 1).alias("end")
    )


def _pieces(cut: DataFrame, length: int) -> DataFrame:
    """Stored (key, whole, anchor, seg, first, windows, bytes) of segments of hot anchors.

    Equal windows have the anchor at one offset, so pieces of STEP offsets, counted from the
    anchor, meet by their key: a hash of the anchor, the piece's number and the bytes that any
    window of these offsets holds. ``whole`` is a hash of all bytes and offsets of the piece.
    """
    once = cut.select("anchor", "seg", "at", "bytes").dropDuplicates(["anchor", "seg"])
    names = ["key", "whole", "anchor", "seg", "first", "windows", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, seg, at, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                # Offsets at, at - 1, ... belong to windows 0, 1, ...
                n = len(data) - length + 1
                block = np.arange((at - n + 1) // STEP, at // STEP + 1)
                first = np.maximum(at - (block * STEP + STEP - 1), 0)
                last = np.minimum(at - block * STEP, n - 1)
                rolling = Rolling(np.frombuffer(data, np.uint8))
                shared = rolling.of(at - block * STEP, at - block * STEP - STEP + 1 + length)
                whole = rolling.of(first, last + length)
                number = block.astype(np.uint64)
                key = scramble(shared + scramble(number + np.uint64(anchor % (1 << 64))))
                whole = scramble(whole + scramble((at - first).astype(np.uint64)))
                k = len(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(np.full(k, anchor, np.int64)),
                        pa.array(np.full(k, seg, np.int64)),
                        pa.array(first.astype(np.int32)),
                        pa.array((last - first + 1).astype(np.int32)),
                        pa.array([data[f : e + length] for f, e in zip(first, last, strict=True)], pa.binary()),
                    ],
                    names,
                )

    return stored(
        once.mapInArrow(
            run, "key long, whole long, anchor long, seg long, first int, windows int, bytes binary"
        ),
        "suffix-pieces",
    )


def _divided(cut: DataFrame, length: int) -> DataFrame:
    """Repeated windows (anchor, seg, start, end) of hot anchors, piece by piece."""
    pieces = _pieces(cut, length)
    of = F.struct("anchor", "seg", "first", "windows", "bytes")
    by_piece = stored(
        pieces.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(of).alias("one")),
        "suffix-different",
    )
    mixed = _mixed(by_piece.select(F.col("key").alias("anchor"), "n"))
    wanted = by_piece.join(mixed.withColumnRenamed("anchor", "key").hint("merge"), "key").select(
        F.col("key").alias("anchor"), F.col("whole").alias("seg"), "hot", F.col("one.bytes").alias("bytes")
    )
    runs = _sorted_shards(wanted.where("NOT hot"), length).unionByName(
        _counted_windows(wanted.where("hot"), length)
    )
    runs = runs.select(F.col("anchor").alias("key"), F.col("seg").alias("whole"), "start", "end")
    single = by_piece.where("n = 1").select("key", "whole", "one.anchor", "one.seg", "one.first")
    some = runs.join(single.hint("merge"), ["key", "whole"]).select(
        "anchor", "seg", (F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end")
    )
    several = by_piece.where("n > 1").select("key", "whole")
    full = pieces.drop("bytes").join(several.hint("merge"), ["key", "whole"]).select(
        "anchor", "seg", F.col("first").alias("start"), (F.col("first") + F.col("windows")).alias("end")
    )
    return some.unionByName(full)


def _mixed(different: DataFrame) -> DataFrame:
    """(anchor, hot) of anchors that have several different segments, one of them only once;
    ``different`` has a row (anchor, n) for each segment."""
    return (
        different.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("different"), F.min("n").alias("fewest"))
        .where("different > 1 AND fewest = 1")
        .select("anchor", (F.col("different") > HOT).alias("hot"))
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, th, ranges): byte ranges (start, end) that repeated strings cover, unmerged."""
    places = _places(docs, length, anchor)
    # Stored by itself, so that the join below may split the places of a hot anchor.
    often = stored(
        places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
        "suffix-often",
    )
    places = stored(places.join(often.hint("merge"), "anchor"), "suffix-places")
    by_seg = stored(
        places.groupBy("anchor", "seg").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("doc_id", "th", "first", "windows", "at")).alias("place"),
        ),
        "suffix-distinct",
    )
    mixed = _mixed(by_seg.select("anchor", "n"))
    wanted = by_seg.join(mixed.hint("merge"), "anchor").select("anchor", "seg", "hot", "place")
    cut = _cut_segments(docs, wanted, length)
    runs = _sorted_shards(cut.where("NOT hot"), length).unionByName(
        _divided(cut.where("hot"), length)
    )
    # A segment of one place takes its runs there; one of several is repeated as a whole.
    single = by_seg.where("n = 1").select("anchor", "seg", "place")
    some = runs.join(single.hint("merge"), ["anchor", "seg"]).select(
        "place.doc_id",
        "place.th",
        (F.col("place.first") + F.col("start")).alias("start"),
        (F.col("place.first") + F.col("end") - 1 + length).alias("end"),
    )
    several = by_seg.where("n > 1").select("anchor", "seg")
    full = places.join(several.hint("merge"), ["anchor", "seg"]).select(
        "doc_id", "th", F.col("first").alias("start"), (F.col("first") + F.col("windows") - 1 + length).alias("end")
    )
    return (
        some.unionByName(full)
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    )


def keep_mask(size: int, ranges: list[tuple[int, int]]) -> np.ndarray:
    change = np.zeros(size + 1, np.int32)
    if ranges:
        starts, ends = np.array(ranges).T
        np.add.at(change, starts, 1)
        np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) == 0


def remove_repeats(docs: DataFrame, *more: str, length: int = LENGTH) -> DataFrame:
    """Every row of docs (doc_id, text, *more) with the bytes that no repeated string covers.

    (doc_id, kept binary, n_bytes, n_removed, n_spans, *more). Texts are their UTF-8 bytes, NULL
    is empty; texts under ``length`` bytes lose nothing; repeated rows lose all from ``length``
    bytes on; matches may overlap, and lie in one document as well as in two. ``kept`` may break
    a character that the bytes of a repeated string break.
    """
    ranges = repeated_ranges(docs, length)
    text = whole_text()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"),
        *more,
    )
    ranges = ranges.select(F.col("doc_id").alias("range_id"), F.col("th").alias("range_th"), "ranges")
    on = rows["doc_id"].eqNullSafe(ranges["range_id"]) & (rows["th"] == ranges["range_th"])
    joined = rows.join(ranges.hint("merge"), on, "left").select("doc_id", "text", "ranges", *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                mask = keep_mask(len(data), [(c["start"], c["end"]) for c in cuts or ()])
                low, _ = _runs(~mask)
                own = np.frombuffer(data, np.uint8)[mask].tobytes()
                kept.append(own)
                sizes.append(len(data))
                removed.append(len(data) - len(own))
                spans.append(len(low))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary())]
                + [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
                + [batch.column(c) for c in more],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", *more],
            )

    types = dict(docs.dtypes)
    extra = "".join(f", `{c}` {types[c]}" for c in more)
    return joined.mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long" + extra
    )


def deduplicated_documents(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents (doc_id, text, lang, source, n_chars) without repeated strings. A character of
    which a cut leaves only some bytes is left out; a document of which nothing is left, or
    nothing but white space, is dropped unless nothing was cut from it."""
    cut = remove_repeats(docs.select("doc_id", "text", "lang", "source"), "lang", "source", length=length)

    @F.pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    texts = cut.withColumn("text", readable("kept")).where("n_removed = 0 OR text RLIKE '[^\\\\s]'")
    return texts.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
