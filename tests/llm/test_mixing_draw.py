"""The draw of slots against the exact distribution, and on both sides of the library's limit."""

import math
from collections import Counter

import numpy as np
import pytest

from txnlake.llm import mixing


def exact(good, bad, sample):
    """Probabilities by exact integers."""
    ways = math.comb(good + bad, sample)
    lows = range(max(0, sample - bad), min(good, sample) + 1)
    return {k: float(math.comb(good, k) * math.comb(bad, sample - k) / ways) for k in lows}


def off(drawn, chances, n):
    """Chi-square over cells of at least ten expected draws, in deviations from its mean."""
    cells, seen, want = [], 0, 0.0
    for k, p in sorted(chances.items()):
        seen, want = seen + drawn[k], want + p * n
        if want >= 10:
            cells.append((seen, want))
            seen, want = 0, 0.0
    if want and cells:
        cells[-1] = (cells[-1][0] + seen, cells[-1][1] + want)
    chi = sum((s - w) ** 2 / w for s, w in cells)
    return (chi - (len(cells) - 1)) / math.sqrt(2 * max(len(cells) - 1, 1))


CASES = [(300, 500, 250), (40, 1000, 400), (500, 500, 500), (15, 20, 16)]


@pytest.mark.parametrize("good, bad, sample", CASES)
def test_ratio_of_uniforms_follows_the_exact_distribution(good, bad, sample):
    rng = np.random.default_rng(5)
    drawn = Counter(mixing._by_ratio(rng, good, bad, sample) for _ in range(20_000))
    assert abs(off(drawn, exact(good, bad, sample), 20_000)) < 5


@pytest.mark.parametrize("limit, one_by_one", [(0, 1000), (0, 12)])
@pytest.mark.parametrize("good, bad, sample", [*CASES, (900, 100, 700), (3, 50, 40), (60, 7, 5)])
def test_every_way_to_draw_is_the_same_distribution(monkeypatch, good, bad, sample, limit, one_by_one):
    monkeypatch.setattr(mixing, "LIBRARY_SLOTS", limit)
    monkeypatch.setattr(mixing, "ONE_BY_ONE", one_by_one)
    rng = np.random.default_rng(6)
    drawn = Counter(mixing.hypergeometric(rng, good, bad, sample) for _ in range(3000))
    assert abs(off(drawn, exact(good, bad, sample), 3000)) < 5


@pytest.mark.parametrize("total", [999_999_999, 1_000_000_000, 1_000_000_001, 10**12, 10**15])
@pytest.mark.parametrize("share", [1e-9, 1e-3, 0.3, 0.9])
def test_moments_around_and_far_beyond_the_limit(total, share):
    good = max(1, int(total * share))
    sample, rng, n = total // 2 + 1, np.random.default_rng(7), 400 if total * share < 1000 else 4000
    drawn = np.array([mixing.hypergeometric(rng, good, total - good, sample) for _ in range(n)], float)
    mean = sample * good / total
    spread = math.sqrt(mean * (total - good) / total * (total - sample) / (total - 1))
    assert abs(drawn.mean() - mean) < 5 * spread / math.sqrt(n)
    assert abs(drawn.std() / spread - 1) < (0.15 if n == 400 else 0.06) or good < 20


def test_log_growth_is_the_quotient_of_factorials():
    for x, d in [(0, 3), (5, -2), (999_999, 4), (1_000_100, -150), (3_000_000, 40_000), (2_000_000, -3000)]:
        lo, hi = min(x, x + d), max(x, x + d)
        want = math.fsum(math.log(i / max(x, 1)) for i in range(lo + 1, hi + 1)) * (1 if d > 0 else -1)
        assert mixing._log_growth(x, d) == pytest.approx(want, abs=1e-5)


@pytest.mark.parametrize("slots", [[0, 3, 10**9 - 4, 7], [6 * 10**8, 0, 5 * 10**8, 9], [10**13, 1, 4 * 10**12]])
def test_shards_beyond_the_limit_are_full_and_follow_each_other(slots):
    slots, memo = np.array(slots), {}
    n = -(-int(slots.sum()) // mixing.SHARD_SLOTS)
    for shard in (0, 1, n // 3, n - 2):
        counts, before = mixing.shard_counts(shard, slots, 3, memo)
        following, until = mixing.shard_counts(shard + 1, slots, 3, memo)
        assert (until == before + counts).all() and (counts >= 0).all()
        assert counts.sum() == mixing.SHARD_SLOTS and before.sum() == shard * mixing.SHARD_SLOTS
    assert (until + following == slots).all()
