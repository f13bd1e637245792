"""Plans against the optimum of small cases, and their bound."""

import math
import random
from collections import Counter

import pytest

from geospan.llm import packing


def optimum(sizes, capacity):
    """Fewest bins, by subsets."""
    n = len(sizes)
    best = [(math.inf, 0)] * (1 << n)  # bins used, room taken in the last
    best[0] = (0, capacity)
    for s in range(1 << n):
        bins, taken = best[s]
        for k in range(n):
            if not s >> k & 1:
                new = (bins, taken + sizes[k]) if taken + sizes[k] <= capacity else (bins + 1, sizes[k])
                best[s | 1 << k] = min(best[s | 1 << k], new)
    return best[-1][0]


def check(counts, capacity, effort=20_000):
    plan = packing.plan(dict(counts), capacity, effort)
    used = Counter()
    for filling, times in plan:
        assert sum(filling) <= capacity and times > 0
        for n in filling:
            used[n] += times
    assert used == Counter({n: c for n, c in counts.items() if c})
    total = sum(t for _, t in plan)
    assert total >= packing.least_sequences(counts, capacity)
    return total


def test_small_cases_are_optimal():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 12))]
        want = optimum(sizes, 100)
        assert check(Counter(sizes), 100) == want == check(Counter(sizes), 100, None)
        assert packing.least_sequences(Counter(sizes), 100) <= want
    assert check(Counter({40: 2, 44: 2, 33: 1, 48: 1, 28: 1, 19: 1, 39: 1, 43: 1}), 100) == 4


def test_branch_finds_or_refutes():
    rng = random.Random(2)
    for _ in range(150):
        sizes = [rng.randrange(10, 70) for _ in range(rng.randrange(1, 11))]
        best = optimum(sizes, 100)
        found = packing.branch(Counter(sizes), 100, best, None)
        assert found is not None and len(found) <= best and Counter(n for f in found for n in f) == Counter(sizes) and all(sum(f) <= 100 for f in found)
        assert best == 0 or packing.branch(Counter(sizes), 100, best - 1, None) is None
    assert packing.branch(Counter(sizes), 100, best, 0) is None  # no effort, no answer
    assert packing.branch({}, 100, 0) == []


@pytest.mark.parametrize("low, high", [(1, 1024), (300, 700), (1024, 1025), (513, 1024)])
def test_large_plans_hold_every_piece(low, high):
    rng = random.Random(low)
    counts = Counter(rng.randrange(low, high) for _ in range(40_000))
    total = check(counts, 1024)
    assert total <= packing.least_sequences(counts, 1024) * 1.08 + 1
    assert check({}, 1024) == 0
