"""SentencePiece encoding against the library: ids, spans, decoding, compiled character maps."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from txnlake.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  a  b ", "\0a\0 b", "▁x ▁▁ y", "\n\n a\n", "a\r\n<s></s>", "<0x0A>", "漢字😀 é́ ﷺ", "x" * 3000,
    " " * 100, "\t", "⁇ <unk>", "ﬁ é Å ｶﾞ  ㍿ 　x Å ½ ", "①② ｱｲｳ  ", "   ", "ạ́b ​ z﻿",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    rng = random.Random(5)
    drawn = ["".join(rng.choice("aeẹ́́ ﬁ½ 　​㍿ｶﾞ\tkK Ω\n") for _ in range(20)) for _ in range(150)]
    return ODD + drawn + [r.text or "" for r in rows]


def assert_as_library(path, texts):
    model, library = pieces.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for text, (ids, spans) in zip(texts, model.encode_many(texts), strict=True):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert model.decode(want) == library.decode(want)
        proto = library.encode(text, return_type="proto")
        assert [tuple(s) for s in spans[1:-1].tolist()] == [(p.begin, p.end) for p in proto.pieces]


def test_ids_spans_and_decoding_equal_the_library(texts):
    assert_as_library(PATH, texts)


def test_words_forgotten_in_between_change_nothing(texts, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_CHARS", 50)
    assert_as_library(PATH, texts[:60])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("flags", [(0, 1), (1, 0), (1, 1)])
def test_compiled_character_maps(texts, tmp_path, rule, flags):
    """The same pieces behind other maps, dummy prefixes and removal of extra spaces."""
    model = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = {}
    for number, value in pieces.wire_fields(model):
        if number == 3:
            spec |= dict(pieces.wire_fields(value))
    body = pieces._message(2, spec[2]) + bytes([3 << 3, flags[0], 4 << 3, flags[1]])
    path = tmp_path / "own.model"
    with open(PATH, "rb") as file:
        path.write_bytes(file.read() + pieces._message(3, body))
    assert_as_library(str(path), texts[:120])


def test_decoding_of_any_ids():
    model, library = pieces.PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(1)
    choices = [1, 2, 28705, 259, *range(3, 259)]
    for _ in range(2000):
        ids = [rng.choice([*choices[: rng.choice([4, 260])], rng.randrange(259, 32000)]) for _ in range(rng.randrange(1, 8))]
        assert model.decode(ids) == library.decode(ids)


def test_documents(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, None, "x", 1), (3, texts[3], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_pieces int")
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    read = pieces.decode_documents(pieces.encode_documents(docs, PATH), PATH)
    got = sorted((r.doc_id is None, r.doc_id, bytes(r.ids), r.text, r.n_pieces, r.span_bytes) for r in read.collect())
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i is None, i, np.array(ids, "<u4").tobytes(), library.decode(ids), len(ids), len((t or "").encode())))
    assert got == sorted(want)
    assert read.where(F.lit(False)).count() == 0
    assert pieces.encode_documents(docs.limit(0), PATH).count() == 0


def test_query_digests(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_sentence_pieces"](spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = library.encode(text[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
