"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by the longest prefixes that the model's compiled character map knows;
characters it does not know stay as they are. Every normalised character records the source byte
it came from, so that the pieces over the normalised text project to byte spans of the source.

No piece joins a word's end to a following space mark, nor anything to a line feed (checked when
a model is read), so merges never cross these places: texts are cut there, and each distinct word
is merged once by the library's merger, run without any normalising of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import whole_text

SPACE = "▁"
#: Characters of words a worker remembers in each of two generations. Speed only.
CACHE_CHARS = 8_000_000

#: Field numbers and piece types of the model file's public format.
_PIECES, _NORMALIZER = 1, 3
_NORMAL, _CONTROL, _BYTE = 1, 3, 6
_CHARS_MAP, _DUMMY_PREFIX, _REMOVE_EXTRA = 2, 3, 4


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield key >> 3, value


def _message(number: int, body: bytes) -> bytes:
    size, length = bytearray(), len(body)
    while length > 127:
        size.append(length & 127 | 128)
        length >>= 7
    return bytes([number << 3 | 2, *size, length]) + body


def compiled_rules(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: source string to its replacement.

    The map is a double-array trie over source bytes, whose values are offsets into a pool of
    strings that end in a zero byte.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
    units = np.append(units, np.zeros(-len(units) % 256, np.int64))
    pool = blob[4 + size :]
    labels, rules, open_nodes = np.arange(1, 256), {}, [(0, b"")]
    while open_nodes:
        node, key = open_nodes.pop()
        unit = int(units[node])
        base = node ^ unit >> 10 << ((unit & 1 << 9) >> 6)
        if unit >> 8 & 1:
            start = int(units[base]) & 0x7FFFFFFF
            rules[key.decode()] = pool[start : pool.index(b"\0", start)].decode()
        at = base ^ labels
        for byte in labels[units[at] & 0x800000FF == labels].tolist():
            open_nodes.append((base ^ byte, key + bytes([byte])))
    return rules


class CharacterMap:
    """Longest-prefix normalising with source alignment."""

    def __init__(self, rules: dict[str, str]):
        self.rules = rules
        by_start: dict[str, list[str]] = {}
        for key in rules:
            by_start.setdefault(key[0], []).append(key)
        self.by_start = {c: sorted(keys, key=len, reverse=True) for c, keys in by_start.items()}
        # Where a rule can apply: a character with a rule of its own, or one whose rules all go
        # on with some character that follows here.
        single = [k for k in rules if len(k) == 1]
        firsts = {k[0] for k in rules if len(k) > 1} - set(single)
        seconds = {k[1] for k in rules if len(k) > 1}
        group = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
        parts = [group(single)] if single else []
        parts += [f"{group(firsts)}(?={group(seconds)})"] if firsts else []
        self.candidates = re.compile("|".join(parts)) if parts else None

    def apply(self, text: str) -> tuple[str, np.ndarray]:
        """The mapped text and, for each of its characters and its end, the source character."""
        if self.candidates is None:
            return text, np.arange(len(text) + 1)
        out, source, at = [], [], 0
        while found := self.candidates.search(text, at):
            start = found.start()
            key = next((k for k in self.by_start[text[start]] if text.startswith(k, start)), text[start])
            new = self.rules.get(key, key)
            out += [text[at:start], new]
            source += [np.arange(at, start), np.full(len(new), start)]
            at = start + len(key)
        out.append(text[at:])
        source.append(np.arange(at, len(text) + 1))
        return "".join(out), np.concatenate(source)


@lru_cache(maxsize=2)
def character_map(blob: bytes) -> CharacterMap:
    return CharacterMap(compiled_rules(blob))


class PieceModel:
    """A model file: its normalising, its pieces, and a memory of encoded words."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            data = file.read()
        pieces, spec = [], {}
        for number, value in wire_fields(data):
            if number == _PIECES:
                piece = dict(wire_fields(value))
                pieces.append((piece[1].decode(), piece.get(3, _NORMAL)))
            elif number == _NORMALIZER:
                spec |= dict(wire_fields(value))
        kinds = [kind for _, kind in pieces]
        if kinds.count(_BYTE) != 256 or set(kinds) - {_NORMAL, 2, _CONTROL, _BYTE}:
            raise ValueError("the model needs a piece for every byte and no symbols of its own")
        if len(pieces) > 1 << 16 or max(len(p) for p, _ in pieces) >= 1 << 15:
            raise ValueError("ids and lengths of pieces are kept in 16 bits")
        self.map = character_map(spec.get(_CHARS_MAP, b""))
        self.prefix = SPACE if spec.get(_DUMMY_PREFIX, 1) else ""
        self.strip = bool(spec.get(_REMOVE_EXTRA, 1))
        normal = [p for p, kind in pieces if kind == _NORMAL]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece goes on after a space mark; words cannot be cut apart")
        self.line_feed_alone = not any("\n" in p for p in normal if len(p) > 1)

        #: How many characters each id stands for, its value as a byte or -1, what it decodes to.
        self.chars = np.array([len(p) if kind == _NORMAL else 0 for p, kind in pieces], np.int32)
        self.byte = np.array([int(p[3:-1], 16) if kind == _BYTE else -1 for p, kind in pieces], np.int32)
        self.surface = [
            p.replace(SPACE, " ").encode() if kind == _NORMAL
            else bytes([int(p[3:-1], 16)]) if kind == _BYTE
            else b"" if kind == _CONTROL
            else " ⁇ ".encode()
            for p, kind in pieces
        ]
        # A later message of the same field overrides: words come normalised already.
        plain = bytes([_DUMMY_PREFIX << 3, 0, _REMOVE_EXTRA << 3, 0, 5 << 3, 1]) + _message(_CHARS_MAP, b"")
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=data + _message(_NORMALIZER, plain))
        self.controls = [i for i, kind in enumerate(kinds) if kind == _CONTROL]
        self.bos, self.eos = self.merger.bos_id(), self.merger.eos_id()
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.remembered = 0

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the source byte."""
        size = np.frombuffer(text.encode(), np.uint8)
        starts = np.append(np.flatnonzero((size & 0xC0) != 0x80), len(size))
        if not text:
            return "", np.zeros(1, np.int64)
        mapped, source = self.map.apply(text)
        align = starts[source]
        if self.strip:
            own = np.frombuffer(mapped.encode("utf-32-le"), np.uint32) == 32
            words = np.flatnonzero(~own)
            if not len(words):
                return "", np.zeros(1, np.int64)
            keep = ~own | np.append(False, ~own[:-1])  # a space after a character
            keep[words[-1] + 1 :] = False
            mapped = "".join(c for c, k in zip(mapped, keep, strict=True) if k)
            align = np.append(align[:-1][keep], align[words[-1] + 1])
        first = align[:1] if self.strip else np.zeros(1, np.int64)
        if self.prefix:
            align = np.concatenate([first, align])
        return self.prefix + mapped.replace(" ", SPACE), align

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """For each word its ids, with the characters that each stands for in the upper 16 bits."""
        if self.remembered > CACHE_CHARS:
            # Words still in use move over from the old generation; the others are forgotten.
            self.old, self.known, self.remembered = self.known, {}, 0
        known, old = self.known, self.old
        new = [w for w in words if w not in known]
        self.remembered += sum(map(len, new))
        known.update((w, old[w]) for w in new if w in old)
        new = [w for w in new if w not in known]
        if new:
            found = self.merger.encode(new, num_threads=1)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter((i for f in found for i in f), np.int32, int(sizes.sum()))
            byte = self.byte[ids]
            # A character outside the vocabulary is several byte pieces; the last stands for it.
            follows = np.append(byte[1:], -1)
            follows[np.cumsum(sizes)[sizes > 0] - 1] = -1
            ends = (byte >= 0) & ((follows < 0) | (follows & 0xC0 != 0x80))
            packed = (ids | (self.chars[ids] + ends) << 16).tobytes()
            edge = [0, *(np.cumsum(sizes) * 4).tolist()]
            known.update(zip(new, [packed[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)], strict=True))
        return list(map(known.__getitem__, words))

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Words of normalised texts: lists of strings, cut where no merge can cross."""
        plain = pc.replace_substring(texts, SPACE, "\0" + SPACE)
        if self.line_feed_alone:
            plain = pc.replace_substring(plain, "\n", "\0\n\0")
        cut = pc.split_pattern(plain, "\0")
        # Runs of spaces are one piece each; a text with a zero byte of its own is left whole.
        odd = pc.or_(pc.match_substring(texts, SPACE * 2), pc.match_substring(texts, "\0"))
        if not pc.any(odd).as_py():
            return cut
        runs = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        lists = cut.to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            text = texts[int(i)].as_py()
            lists[i] = [text] if "\0" in text else runs.findall(text)
        return pa.array(lists, pa.list_(pa.string()))

    def encode_many(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids with begin and end, and their (begin, end) bytes in the source."""
        normal = [self.normalise(t) for t in texts]
        cut = self._cut(pa.array([n for n, _ in normal], pa.string()))
        words = cut.flatten().dictionary_encode()
        of_word = self._encode_words(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
        flat = np.frombuffer(b"".join(of_word), np.int32)
        at = words.indices.to_numpy()
        starts = np.append(0, np.cumsum(sizes))[at]
        places = np.append(0, np.cumsum(sizes[at]))
        packed = flat[np.arange(places[-1]) + np.repeat(starts - places[:-1], sizes[at])]
        bounds = places[cut.offsets.to_numpy()]
        out = []
        for (_, align), a, b in zip(normal, bounds[:-1], bounds[1:], strict=True):
            own = packed[a:b]
            upto = np.append(0, np.cumsum(own >> 16))
            ids = np.concatenate([[self.bos], own & 0xFFFF, [self.eos]]).astype("<u4")
            edge = align[upto]
            spans = np.zeros((len(ids), 2), "<u4")
            spans[1:-1, 0], spans[1:-1, 1] = edge[:-1], edge[1:]
            spans[-1] = align[-1]
            out.append((ids, spans))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: begin and end say nothing, bytes are joined, the first space mark of
        a model that adds one goes."""
        runs = [ids]
        if any(i in ids[1:-1] for i in self.controls):  # bytes on both sides are not joined
            runs = np.split(ids, np.flatnonzero(np.isin(ids, self.controls)))
        text = "".join(_readable(b"".join(map(self.surface.__getitem__, run))) for run in runs)
        if self.prefix or self.strip:
            first = next((i for i in ids if self.surface[i]), None)
            if first is not None and self.byte[first] < 0:
                text = text.removeprefix(" ") if not self.strip else text.lstrip(" ")
        return text


def _readable(data: bytes) -> str:
    """Bytes as text; bytes that are no character count one replacement each."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return re.sub("[\udc80-\udcff]", "�", data.decode(errors="surrogateescape"))


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, spans): ids of the whole text with begin and end, as little-endian unsigned
    32-bit integers, and for each id its first byte in the source and the byte after its last,
    in the same form, pair by pair.

    NULL text is empty and has begin and end alone; rows without a doc_id and repeated rows are
    kept; an empty table gives no rows. Only doc_id and text are read, so further columns, whatever their
    names, change nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            found = model.encode_many(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([ids.tobytes() for ids, _ in found], pa.binary()),
                    pa.array([spans.tobytes() for _, spans in found], pa.binary()),
                ],
                ["doc_id", "ids", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id long, ids binary, spans binary"
    )


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text, n_pieces, span_bytes) of encoded documents: the decoded text, and how
    many source bytes the spans of the pieces cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            ids = [np.frombuffer(x, "<u4") for x in batch.column("ids").to_pylist()]
            spans = [np.frombuffer(x, "<u4") for x in batch.column("spans").to_pylist()]
            covered = [int(s[1::2].sum(dtype=np.int64) - s[::2].sum(dtype=np.int64)) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("ids"),
                    pa.array([model.decode(i.tolist()) for i in ids], pa.string()),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array(covered, pa.int64()),
                ],
                ["doc_id", "ids", "text", "n_pieces", "span_bytes"],
            )

    return encoded.select("doc_id", "ids", "spans").mapInArrow(
        run, "doc_id long, ids binary, text string, n_pieces long, span_bytes long"
    )
