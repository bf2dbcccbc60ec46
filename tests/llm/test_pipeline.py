"""The pipeline on the smallest tables: every stage against brute force on its own input."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR
from test_documents import brute_classes, brute_cut

import corpus_pipeline
from txnlake.llm import mixing, toxicity
from txnlake.llm.common import read_table, stored
from txnlake.llm.queries import tokenizer_file
from txnlake.llm.tokens import PieceEncoder


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF_DIR), f"test-{name}"))
    return docs


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns_stay_until_the_last_stage(stages):
    assert all(set(d.columns) == set(stages[0].columns) for d in stages[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "mix", "pack"]


def test_toxic_documents_go(spark, stages):
    scores = toxicity.score_toxicity(stages[0], read_table(spark, SF_DIR, "labels", "doc_id", "toxic"))
    clean = sorted(r.doc_id for r in scores.where("predicted = 0").collect())
    assert [i for i, _ in rows(stages[1])] == clean


def test_one_of_each_class_stays(stages):
    classes = brute_classes(rows(stages[1]))
    assert [i for i, _ in rows(stages[2])] == sorted({c for _, c in classes})


def test_repeats_are_cut(stages):
    before = rows(stages[2])
    want = []
    for (doc_id, text), cut in zip(before, brute_cut([(t or "").encode() for _, t in before], 200), strict=True):
        kept = cut[3].decode("utf-8", "ignore")
        if not cut[1] or kept.strip():
            want.append((doc_id, kept))
    assert rows(stages[3]) == want


def test_sources_meet_their_targets(stages):
    size, taken = Counter(), Counter()
    for r in stages[3].collect():
        size[r.source] += len(r.text.split())
    for r in stages[4].collect():
        taken[r.source] += len(r.text.split())
    for source, target in mixing.source_targets(size).items():
        assert abs(taken[source] - target) <= 3 * mixing.BLOCK_WORDS


def test_pieces_hold_the_tokens_of_the_mix(stages):
    library = PieceEncoder(tokenizer_file("word_bpe_49k.json")).tokenizer
    want = Counter()
    for doc_id, text in rows(stages[4]):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), corpus_pipeline.CAPACITY):
            own = np.array(ids[k : k + corpus_pipeline.CAPACITY], "<u4").tobytes()
            want[doc_id, k // corpus_pipeline.CAPACITY, zlib.crc32(own)] += 1
    packed = stages[5].collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed) == want
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in map(sorted, bins.values()):
        assert [o for o, _ in content] == np.cumsum([0] + [n for _, n in content])[:-1].tolist()
        assert sum(n for _, n in content) <= corpus_pipeline.CAPACITY
