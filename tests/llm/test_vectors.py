"""Vector searches against brute force."""

import numpy as np
import pytest

from txnlake.llm import ann, topk, vectors

SCHEMA = "vec_id long, embedding array<double>, key int, dim string"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    data = np.round(rng.normal(size=(900, 12)), 2)
    data[300:600] = data[7]  # a large group of equal vectors
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(data)]
    rows += [(20, data[20].tolist(), 1, "x"), (None, data[1].tolist(), 1, "x"), (2000, None, 1, "x")]
    rows += [(2001, [], 1, "x"), (2002, [float("nan")] * 12, 1, "x"), (2003, [None] + [1.0] * 11, 1, "x")]
    rows += [(2004, [float("inf")] * 12, 1, "x"), (2020, [0.0] * 12, 1, "x"), (2040, [1.0] * 5, 1, "x"), (2041, [2.0] * 5, 1, "x")]
    return data, spark.createDataFrame(rows, SCHEMA)


def brute(ids, data, queries, k, zero):
    out = {}
    for q in queries:
        rows = [(-(data[q] @ data[i]), i) for i in ids if i != q and len(data[i]) == len(data[q])]
        out[q] = [(i, -s) for s, i in sorted(rows)[:k]]
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


@pytest.mark.parametrize("stripe", [100, 100_000])
def test_exact_top_k(table, monkeypatch, stripe):
    monkeypatch.setattr(vectors, "STRIPE_ROWS", stripe)
    monkeypatch.setattr(vectors, "GROUP_ROWS", 30)
    data, df = table
    whole = {i: np.floor(256 * v).astype(int) for i, v in enumerate(data)}
    whole |= {2020: np.zeros(12, int), 2040: np.full(5, 256), 2041: np.full(5, 512)}
    queries = [i for i in whole if i % 20 == 0]
    got = collected(topk.top_k(df, df.where("vec_id % 20 = 0"), 5))
    assert got == {q: r for q, r in brute(whole, whole, queries, 5, True).items() if r}


@pytest.mark.parametrize("stripe", [100, 100_000])
def test_nearest(table, monkeypatch, stripe):
    monkeypatch.setattr(vectors, "STRIPE_ROWS", stripe)
    data, df = table
    whole = dict(enumerate(data)) | {2040: np.full(5, 1.0), 2041: np.full(5, 2.0)}
    queries = [i for i in whole if i % 20 == 0]
    got = collected(ann.nearest(df, df.where("vec_id % 20 = 0"), 20))
    want = brute(whole, whole, queries, 20, False)
    assert set(got) == {q for q, r in want.items() if r}
    for q, rows in got.items():
        assert [s for _, s in rows] == pytest.approx([s for _, s in want[q]])
        if 300 <= q < 600:
            assert [i for i, _ in rows][:5] == [i for i, _ in want[q]][:5]


def test_empty_tables(table):
    _, df = table
    assert topk.top_k(df.limit(0), df, 5).count() == 0 and ann.nearest(df, df.limit(0), 5).count() == 0
