"""Hard negatives against brute force, and the bounds of segment summaries."""

import numpy as np
import pytest

from check import compare
from txnlake.llm import queries, segments

SCHEMA = "vec_id long, label int, embedding array<double>, key int, payload string, dim int"


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(8)
    data = np.round(rng.normal(size=(700, 20)) + 0.6, 2)
    data[200:400] = data[7]  # a large group of equal vectors
    labels = rng.integers(0, 4, 700)
    labels[:250] = 1
    rows = [(i, int(label), v.tolist()) for i, (label, v) in enumerate(zip(labels, data, strict=True))]
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, data[1].tolist()), (900, None, data[1].tolist()), (901, 1, None), (902, 1, [])]
    odd += [(903, 1, [nan] * 20), (904, 1, [None] + [1.0] * 19), (906, 1, [inf] * 20), (910, 2, [0.0] * 20)]
    odd += [(920, 3, [1.0] * 5), (921, 3, [1.2] * 5), (922, 2, [0.9] * 5), (930, 1, [-1.0] * 20)]
    odd += [rows[10]] * 40 + [(20, 9, data[30].tolist()), (20, 0, data[31].tolist()), (20, 0, (data[31] - 1).tolist())]
    return rows + odd


def brute(rows, is_anchor, n_positives=5, n_negatives=3):
    by_id = {}
    for i, label, v in rows:
        if i is None or label is None or not v or not all(x is not None and np.isfinite(x) for x in v):
            continue
        key = (i, len(v))
        by_id[key] = min(by_id.get(key, (label, v)), (label, v))
    whole = {k: (label, np.floor(256 * np.array(v)).astype(int)) for k, (label, v) in by_id.items()}
    out = set()
    for (a, dim), (label, v) in whole.items():
        if not is_anchor(a):
            continue
        scored = sorted((-int(v @ w), i, other) for (i, d), (other, w) in whole.items() if d == dim and i != a)
        positives = [(-s, i) for s, i, other in scored if other == label][:n_positives]
        for score, p in positives:
            fits = [(-s, i) for s, i, other in scored if other != label and 50 * score <= -100 * s <= 95 * score]
            out |= {(a, p, r + 1, i, score, s) for r, (s, i) in enumerate(fits[:n_negatives])}
    return out


@pytest.mark.parametrize("sizes", [(65_536, 4096, 1024), (150, 50, 16)])
def test_equals_brute_force(spark, table, monkeypatch, sizes):
    for name, size in zip(("STRIPE_ROWS", "LEAST_ROWS", "BLOCK_ROWS"), sizes, strict=True):
        monkeypatch.setattr(segments, name, size)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in table], SCHEMA)
    got = segments.hard_negatives(df, df.where("vec_id % 10 = 0")).collect()
    want = brute(table, lambda i: i % 10 == 0)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_empty_tables(spark, table):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in table[:20]], SCHEMA)
    assert segments.hard_negatives(df.limit(0), df).count() == 0
    assert segments.hard_negatives(df, df.limit(0)).count() == 0


def test_bounds_hold_and_get_tighter():
    rng = np.random.default_rng(3)
    a = segments.Summaries(np.floor(rng.normal(size=(30, 50)) * 90))
    b = segments.Summaries(np.floor(rng.normal(size=(80, 50)) * 90))
    columns, widths = np.arange(80), []
    exact = a.scores(b, columns)
    assert (exact == a.values.astype(int) @ b.values.astype(int).T).all()
    for level in range(len(a.levels)):
        low, high = a.bounds(b, level, columns)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True) and len(widths) == len(segments.LEVELS)


def test_large_components_stay_exact():
    big = np.array([[2.0**28 + 1, 3.0]])
    one = segments.Summaries(big)
    assert one.scores(one, np.arange(1))[0, 0] == (2**28 + 1) ** 2 + 9


def test_query_equals_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op13_hard_negatives"
    ok, note = compare(queries.QUERIES[name](spark, sf), sf, queries.ORACLE_SQL[name])
    assert ok, note
