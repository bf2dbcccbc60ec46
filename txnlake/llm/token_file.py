"""Token ids as a compressed file: canonical length-limited Huffman codes in independent blocks.

A token file is a folder of two Parquet tables. ``codes`` has the code length of each id, from
counts over all documents. ``blocks`` has one row per block: whole documents in order, their ids
as one bit string, and a checkpoint (bit offset) every ``LANE`` ids from which a table-driven
decoder may start. Blocks need nothing but the codes, so any task may read any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import partitions, stored, whole_text
from txnlake.llm.tokens import encode_documents
from txnlake.session import scratch_path

MAX_BITS = 16
LANE = 128
BLOCK_IDS = 1 << 16


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` by package-merge; ties go to smaller ids."""
    if len(counts) > 1 << max_bits:
        raise ValueError(f"{len(counts)} ids do not fit codes of {max_bits} bits")
    if len(counts) == 1:
        return dict.fromkeys(counts, 1)
    ids = sorted(counts, key=lambda i: (counts[i], i))
    n = len(ids)
    weights = np.array([counts[i] for i in ids], np.float64)
    # Each level merges the symbols with the packages (pairs) of the level before; a package
    # is known by its place, so the second pass can count symbols level by level.
    levels, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order)
        row = merged[order]
        even = len(row) // 2 * 2
        packages = row[0:even:2] + row[1:even:2]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for order in reversed(levels):
        chosen = order[:take]
        symbols = chosen[chosen < n]
        lengths[symbols] += 1
        take = 2 * (take - len(symbols))
    return {i: int(b) for i, b in zip(ids, lengths, strict=True)}


class Codebook:
    """Canonical codes of (id, length) pairs, and the table that decodes ``MAX_BITS`` bits at once."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        size = max(order, default=0) + 1
        self.bits = np.zeros(size, np.uint8)
        # Each code as single bits from the left, and which of them count.
        self.spread = np.zeros((size, MAX_BITS), np.uint8)
        self.counts = np.zeros((size, MAX_BITS), bool)
        #: By the next ``MAX_BITS`` bits: the id in the upper bits, the code's length in the lower 8.
        self.table = np.ones(1 << MAX_BITS, np.uint32)
        code = last = 0
        for i in order:
            b = lengths[i]
            code <<= b - last
            last = b
            self.bits[i] = b
            self.spread[i, :b] = [code >> k & 1 for k in range(b - 1, -1, -1)]
            self.counts[i, :b] = True
            self.table[code << (MAX_BITS - b) : (code + 1) << (MAX_BITS - b)] = i << 8 | b
            code += 1

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit string and the bit offset of every ``LANE``-th id; runs of 64 Ki ids start bytes."""
        out, marks, at = [], [], 0
        for k in range(0, len(ids), BLOCK_IDS):
            part = ids[k : k + BLOCK_IDS]
            bits = self.bits[part]
            starts = np.cumsum(bits, dtype=np.int64) - bits
            marks.append(starts[::LANE] + at)
            packed = np.packbits(self.spread[part][self.counts[part]])
            out.append(packed.tobytes())
            at += 8 * len(packed)
        return b"".join(out), np.concatenate(marks) if marks else np.empty(0, np.int64)

    def decode(self, payload: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """All lanes at once, one id of each a step."""
        # The last lane may end early; what it reads beyond the payload is cut off.
        raw = np.frombuffer(payload + bytes(LANE * MAX_BITS // 8 + 4), np.uint8).astype(np.uint32)
        words = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
        out = np.empty(len(marks) * LANE, np.uint32)
        for k in range(0, len(marks), 4096):
            at = marks[k : k + 4096].astype(np.int64)
            lanes = np.empty((LANE, len(at)), np.uint32)
            for step in range(LANE):
                peek = (words[at >> 3] >> (8 - (at & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
                hit = self.table[peek]
                lanes[step] = hit
                at += hit & np.uint32(0xFF)
            out[k * LANE : (k + len(at)) * LANE] = (lanes.T >> np.uint32(8)).ravel()
        return out[:n]


def ordered_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(part, seq, doc_id, before, n_tokens, ids) in ascending (part, seq), which is doc_id order.

    ``before`` counts the ids of earlier rows of the same part. Rows with one doc_id are
    ordered by a hash of their text, which also splits them over parts.
    """
    dtype = "<u2"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    tie = F.xxhash64("text")
    dealt = texts.repartitionByRange(partitions(docs.sparkSession), "doc_id", tie)
    encoded = encode_documents(dealt.sortWithinPartitions("doc_id", tie), tokenizer, end_id)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("ids").to_pylist()], np.int64)
            sizes //= np.dtype(dtype).itemsize
            n = len(sizes)
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(seq, seq + n, dtype=np.int64)),
                    batch.column("doc_id"),
                    pa.array(ends - sizes),
                    pa.array(sizes),
                    batch.column("ids"),
                ],
                ["part", "seq", "doc_id", "before", "n_tokens", "ids"],
            )
            seq, before = seq + n, int(ends[-1]) if n else before

    return encoded.mapInArrow(
        number, "part int, seq long, doc_id long, before long, n_tokens long, ids binary"
    )


def count_ids(ids: DataFrame) -> dict[int, int]:
    """Occurrences of each id; as many rows as the vocabulary has at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            joined = b"".join(batch.column("ids").to_pylist())
            total += np.bincount(np.frombuffer(joined, "<u2"), minlength=1 << 16)
        (seen,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in counted.collect()}


_BLOCK = (
    "part int, seq long, before long, doc_ids array<long>, doc_sizes array<long>, n_ids long, "
    "payload binary, marks array<long>"
)


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Tokenize, count, and write the token file of all documents in ascending doc_id order."""
    spark = docs.sparkSession
    ids = stored(ordered_ids(docs, tokenizer, end_id), "token-ids")
    lengths = code_lengths(count_ids(ids))
    spark.createDataFrame(list(lengths.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            all_ids = np.frombuffer(b"".join(r[5] for r in held), "<u2")
            payload, marks = book.encode(all_ids)
            row = {
                "part": held[0][0],
                "seq": held[0][1],
                "before": held[0][3],
                "doc_ids": [r[2] for r in held],
                "doc_sizes": [r[4] for r in held],
                "n_ids": len(all_ids),
                "payload": payload,
                "marks": marks.tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=_arrow_block())

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                follows = held and row[0] == held[-1][0] and row[1] == held[-1][1] + 1
                if held and (not follows or size >= BLOCK_IDS):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row[4]
        if held:
            yield block()

    ids.mapInArrow(run, _BLOCK).write.parquet(f"{path}/blocks")


def _arrow_block() -> pa.Schema:
    many = pa.list_(pa.int64())
    return pa.schema(
        [
            ("part", pa.int32()), ("seq", pa.int64()), ("before", pa.int64()), ("doc_ids", many),
            ("doc_sizes", many), ("n_ids", pa.int64()), ("payload", pa.binary()), ("marks", many),
        ]
    )


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids as little-endian unsigned 32 bits.

    ``start`` counts the ids of all documents before it: the totals of earlier parts, of which
    there is one number for each part, and the ids before it in its own.
    """
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codes").collect()}
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    offsets, at = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        offsets[r["part"]], at = at, at + r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(lengths)
        for batch in batches:
            for b in batch.to_pylist():
                ids = book.decode(b["payload"], np.array(b["marks"], np.int64), b["n_ids"])
                sizes = np.array(b["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                cut = [ids[s:e].astype("<u4").tobytes() for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b["doc_ids"], pa.int64()),
                        pa.array(starts + offsets[b["part"]] + b["before"]),
                        pa.array(sizes),
                        pa.array(cut, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def token_file(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the documents to a token file in the shared folder and read them back.

    NULL or empty text gives the end id alone; equal doc_ids stay separate rows, ordered by
    text hash; an empty table gives an empty file.
    """
    path = scratch_path(docs.sparkSession, "token-file")
    write_token_file(docs, path, tokenizer, end_id)
    return read_token_file(docs.sparkSession, path)
