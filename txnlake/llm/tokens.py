"""Tokenizing whole texts with a public tokenizer file, one tokenizer per Python worker.

A text is cut into pieces at white space where the tokenizer's own splitting can never join
across, so each distinct piece is encoded once by the library and then looked up. Where that
is not certain the whole text goes through the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import whole_text

#: Characters of pieces a worker remembers in each of two generations. Speed only.
CACHE_CHARS = 5_000_000
_MARKS = ".,;:!?*#$%&)"
_SINGLE_SPACE = re.compile(r"(?<=\S)(?=\s\S)")


class PieceEncoder:
    """Ids of texts as little-endian bytes, equal to ``Tokenizer.encode(text).ids``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cut = self._kind(spec)
        self.cache: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.chars = 0

    @staticmethod
    def _kind(spec: dict):
        """How texts may be cut: by what the tokenizer's own splitting does with white space."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return _before_spaces
        steps = pre.get("pretokenizers", [])
        drops = [s for s in steps if s.get("type") == "Split" and s.get("invert") and s.get("behavior") == "Removed"]
        known = {"NFC", "Replace", "Lowercase"}
        if drops and r"[^\s" in drops[0]["pattern"].get("Regex", "") and {n["type"] for n in (norm or {}).get("normalizers", [])} <= known:
            return _without_spaces
        return None

    def _bytes(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, self.dtype).tobytes() for e in found]

    def _learn(self, pieces: set[str]) -> None:
        if self.chars > CACHE_CHARS:
            # Pieces still in use move over from the old generation; the others are forgotten.
            self.old, self.cache, self.chars = self.cache, {}, 0
        cache, old = self.cache, self.old
        new = [p for p in pieces if p not in cache]
        self.chars += sum(map(len, new))
        again = [p for p in new if p in old]
        cache.update(zip(again, map(old.__getitem__, again), strict=True))
        new = [p for p in new if p not in old]
        if self.cut is _before_spaces:
            cache.update(dict.fromkeys(new))
            new = list(filter(_clean, new))
        # A letter and a mark after it are never in one token, so "word," is "word" and ",".
        # Only for letters that lower-casing and normalising leave single letters.
        ends: dict[str, tuple[str, str]] = {}
        for p in new:
            core = p.rstrip(_MARKS)
            if len(core) < len(p) and "A" <= core[-1:] < "\u0130" and core[-1].isalpha():
                ends[p] = core, p[len(core) :]
        wanted = {q for pair in ends.values() for q in pair}.union(p for p in new if p not in ends)
        known = {q: cache[q] for q in wanted if cache.get(q) is not None}
        whole = [q for q in wanted if q not in known]
        known.update(zip(whole, self._apart(whole), strict=True))
        cache.update((p, known[p]) for p in new if p not in ends)
        cache.update((p, known[core] + known[marks]) for p, (core, marks) in ends.items())

    def _apart(self, pieces: list[str]) -> list[bytes]:
        """Ids of many short pieces in one call: a special token between two of them keeps them
        apart, since texts are split at special tokens before anything else."""
        if not self.special or not pieces:
            return self._bytes(pieces)
        found = self.tokenizer.encode_batch_fast([self.special[-1].join(pieces)], add_special_tokens=False)
        ids = np.asarray(found[0].ids, self.dtype)
        ends = np.append(np.flatnonzero(ids == self.tokenizer.token_to_id(self.special[-1])), len(ids))
        raw, size = ids.tobytes(), self.dtype.itemsize
        starts = [0, *(ends[:-1] + 1).tolist()]
        return [raw[size * a : size * b] for a, b in zip(starts, ends.tolist(), strict=True)]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. A piece with white space at a cut is None among the known ones;
        its text is cut at single spaces only, where every cut is safe."""
        if self.cut is None:
            return self._bytes(texts)
        cuts = [None if any(s in t for s in self.special) else self.cut(t) for t in texts]
        self._learn(set().union(*filter(None, cuts)))
        known, out = self.cache.__getitem__, []
        for text, pieces in zip(texts, cuts, strict=True):
            if pieces is None:
                out += self._bytes([text])
                continue
            found = list(map(known, pieces))
            out.append(b"".join(self._bytes(_SINGLE_SPACE.split(text)) if None in found else found))
        return out


def _clean(piece: str) -> bool:
    body = piece[1:] if piece[:1] in (" ", "\n") else piece
    if not body:
        return not piece
    return not (body[0].isspace() or body[-1].isspace() or body[0] == "\0")


def _before_spaces(text: str) -> list[str]:
    if "\0" in text:
        return [" \0 "]  # not clean: takes the other way
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def _without_spaces(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_documents(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """(doc_id, ids): ids of the whole text with the end id, as little-endian bytes.

    NULL text is empty and gives the end id alone. Row order within partitions is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        if enc.dtype.itemsize != 2:
            raise ValueError("ids are kept in 16 bits; this vocabulary needs more")
        end = np.asarray([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids = [x + end for x in enc.encode_many(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id long, ids binary"
    )
