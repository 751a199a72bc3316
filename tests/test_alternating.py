"""Exact half-steps against dense normal equations, and what a fit leaves on disk."""

import os

import numpy as np
import pytest

from ranklight.operators.alternating import fit_factors, solve_owners
from ranklight.operators.collaborative import als_fit
from ranklight.operators.factorise import start_factors


def dense_step(ratings, other, regularization, alpha):
    """Rows of ``ratings`` (zero: none) solved one after another."""
    out = []
    for row in ratings:
        weight = alpha * np.abs(row)
        system = other.T @ other + other.T @ (other * weight[:, None])
        system += regularization * (row > 0).sum() * np.eye(other.shape[1])
        out.append(np.linalg.solve(system, other.T @ np.where(row > 0, 1 + weight, 0)) if (row > 0).any() else np.zeros(other.shape[1]))
    return np.array(out)


@pytest.mark.parametrize("rank", [3, 12])
def test_owners_with_few_many_negative_and_no_ratings(rank):
    draw = np.random.default_rng(rank)
    ratings = draw.integers(-1, 6, size=(30, 40)) * (draw.random((30, 40)) < draw.random((30, 1)))
    ratings[3], ratings[4] = 0, -np.abs(ratings[4])
    other = draw.normal(size=(40, rank)).astype(np.float32)
    values, turn = np.linalg.eigh(other.T.astype(float) @ other)
    first = np.concatenate(([0], np.cumsum((ratings != 0).sum(axis=1))))
    found = solve_owners(
        first, np.nonzero(ratings)[1], ratings[ratings != 0].astype(np.float32), other @ turn, (values, turn), 0.1, 7.0
    )
    assert np.allclose(found, dense_step(ratings, other.astype(float), 0.1, 7.0), atol=2e-4)


def test_two_epochs_are_those_of_dense_arithmetic(spark):
    draw = np.random.default_rng(5)
    ratings = draw.integers(1, 6, size=(50, 35)) * (draw.random((50, 35)) < 0.3)
    ratings[0, :] = 1  # an owner with more ratings than factors
    rows = [(int(u), int(i), float(ratings[u, i])) for u, i in zip(*np.nonzero(ratings))]
    matrix = spark.createDataFrame(rows, "user_index int, item_index int, confidence double")
    found = fit_factors(matrix, 4, 2, 0.05, 10.0, 3, 7)
    users, items = ({r["id"]: np.array(r["vector"]) for r in t.collect()} for t in found)
    u = start_factors(np.arange(50, dtype=np.int32), 4, 3).astype(float)
    for _ in range(2):
        i = dense_step(ratings.T, u, 0.05, 10.0)
        u = dense_step(ratings, i, 0.05, 10.0)
    assert np.allclose([users[k] for k in range(50)], u, atol=1e-3)
    assert set(items) == {k for k in range(35) if ratings[:, k].any()}
    assert np.allclose([items[k] for k in sorted(items)], i[sorted(items)], atol=1e-3)


def test_only_the_last_factors_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ranklight.session.scratch_root", lambda _: str(tmp_path))
    rows = [(f"u{u}", f"i{i}", 4.0, 1) for u in range(20) for i in range(u % 3, 20, 3)]
    train = spark.createDataFrame(rows, "user_id string, item_id string, rating double, timestamp long")
    model = als_fit(train, n_factors=3, n_epochs=6)
    assert model.user_factors.count() == 20 and model.item_factors.count() == 20
    left = sorted(name.rsplit("-", 1)[0] for name in os.listdir(tmp_path))
    assert left == ["item-ids", "item_id-factors", "items-6", "user-ids", "user_id-factors", "users-6"]
