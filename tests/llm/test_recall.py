"""The chance to find near copies does not fall with the size of the input."""

import numpy as np
import pytest

from ranklight.llm.hamming import allocate, likely_parts


@pytest.mark.parametrize("n", [10**5, 10**7, 10**9])
def test_pairs_at_the_radius_are_found_at_any_input_size(n):
    both = (np.full((256, 256), 0.25) + np.eye(256) * 0.25) * n
    parts = likely_parts(n, both, 47 / 256)
    member = np.zeros((256, len(parts)))
    for k, (bits, _) in enumerate(parts):
        member[bits, k] = 1
    draw = np.random.default_rng(6)
    flipped = (draw.random((4000, 256)).argsort(1).argsort(1) < 47).astype(float)
    met = (flipped @ member <= [t for _, t in parts]).any(1)
    assert met.mean() >= 0.996


def test_thresholds_equal_those_of_all_choices():
    draw = np.random.default_rng(8)
    for _ in range(20):
        costs = np.sort(draw.integers(1, 50, (4, 2)).astype(float), 1)
        gains = np.sort(draw.integers(0, 6, (4, 2)), 1)
        grid = np.stack(np.meshgrid(*[[-1, 0, 1]] * 4), -1).reshape(-1, 4)
        paid = [sum(costs[k, t] for k, t in enumerate(c) if t >= 0) for c in grid]
        gained = [sum(gains[k, t] for k, t in enumerate(c) if t >= 0) for c in grid]
        least = min([p for p, g in zip(paid, gained) if g >= 9], default=float("inf"))
        cost, chosen = allocate(costs.tolist(), gains.tolist(), 9)
        assert cost == least
        if chosen:
            assert sum(gains[k, t] for k, t in enumerate(chosen) if t >= 0) >= 9
