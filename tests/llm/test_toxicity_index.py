"""Blocks, packing and word counts behind the toxicity scores."""

from collections import Counter

import numpy as np

from txnlake.llm import toxicity


def test_blocks_of_other_languages_are_skipped(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    rng = np.random.default_rng(4)
    own = [tuple(range(30)) for _ in range(64)]
    # An example of the other language has one of the ten shared terms, its block all of them.
    other = [tuple(sorted([20 + i % 10, *(40 + rng.choice(40, 4, replace=False))])) for i in range(64)]
    examples = [(t, tuple(rng.integers(1, 4, len(t)).tolist()), 1, 0, i) for i, t in enumerate(own + other)]
    idf = np.full(80, 2.0)
    index = toxicity.BlockMaxIndex(examples, idf)
    found = index.tiles()
    blocks = found if isinstance(found, list) else found.blocks
    rows = [set(range(64)), set(range(64, 128))] if isinstance(found, list) else [set(found.order[a:z].tolist()) for a, z in found.spans]
    own_rows = {i for i, e in enumerate(sorted(examples)) if e[0] == own[0]}
    assert sorted(map(len, rows)) == [64, 64] and own_rows in rows
    # What is multiplied with the other block shows.
    blocks[1 - rows.index(own_rows)].matrix[:] = np.nan
    dense = np.zeros((128, 80))
    for row, e in enumerate(sorted(examples)):
        dense[row, list(e[0])] = index.unit(e[0], e[1])
    asked = [e for e in examples if e[0] == own[0]]
    for e, (near, sims) in zip(asked, index.search([(e[0], e[1], None) for e in asked], 5), strict=True):
        scores = dense @ dense[sorted(examples).index(e)]
        want = np.flatnonzero(scores >= np.sort(scores)[-5] - 1e-12)
        assert sorted(near.tolist()) == want.tolist() and np.allclose(np.sort(sims), np.sort(scores[want]))


def test_an_index_may_be_empty_or_tiny():
    nothing = toxicity.BlockMaxIndex([], np.zeros(0))
    assert [len(r) for r, _ in nothing.search([((), (), None)], 3)] == [0]
    one = toxicity.BlockMaxIndex([((0, 1), (1, 300), 1, 0, 5)], np.ones(3))
    assert [r.tolist() for r, _ in one.search([((1,), (2,), None), ((), (), None), ((2,), (1,), None)], 3)] == [[0], [], []]


def test_numbers_take_the_bytes_they_need():
    for top, width in ((0, 1), (200, 1), (256, 2), (70_000, 3), (2**31, 4)):
        values = np.array([0, 3, top], np.int64)
        assert toxicity._unpacked(toxicity._packed(values)).tolist() == values.tolist()
        assert len(toxicity._packed(values)) == 1 + 3 * width
    assert toxicity._unpacked(toxicity._packed(np.empty(0, np.int64))).tolist() == []


def test_counts_of_a_batch_are_those_of_each_text():
    texts = ["", "12 _ ,", "Sluggard, (oaf)oaf sluggard's NITWIT. ", "unheard-of ²nd itİs", "oaf", "zzz"]
    terms = ["oaf", "slug*", "slugg*", "sluggard", "nitwit", "nitw*", "s", "of", "²nd", "unhe*"]
    for text, (ids, times, bare) in zip(texts, toxicity._counter(terms)(texts), strict=True):
        want = Counter()
        for word in toxicity._WORD.findall(text.lower()):
            want.update(terms.index(t) for t in toxicity.text_terms(word) if t in terms)
        assert dict(zip(ids.tolist(), times.tolist(), strict=True)) == dict(sorted(want.items()))
        assert ids.tolist() == sorted(want) and bare == (not toxicity._WORD.findall(text.lower()))
