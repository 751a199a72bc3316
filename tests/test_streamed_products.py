"""The search without groups: brute force over several blocks, and nothing written for a cell."""

import numpy as np
import pytest

from ranklight.operators.blocks import best_products


def frame(spark, x, name, kind="float"):
    rows = [(name(k), v) for k, v in enumerate(x.astype(kind).tolist())]
    return spark.createDataFrame(rows, f"id string, vector array<{kind}>")


def brute(queries, items, n, digits, banned=()):
    out = set()
    for k, scores in enumerate(np.round(queries.astype(float) @ items.astype(float).T, digits)):
        there = [i for i in range(len(items)) if (k, i) not in banned]
        first = sorted(there, key=lambda i: (-scores[i], f"i{i}"))[:n]
        out |= {(f"q{k}", f"i{i}", r + 1) for r, i in enumerate(first)}
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_blocks_with_ties_and_seen_pairs(spark, kind):
    draw = np.random.default_rng(6)
    # Few distinct numbers: many products tie across blocks. One query has met all items but two.
    q, x = (draw.integers(-2, 3, size=(rows, 4)).astype(float) for rows in (90, 210))
    banned = {(int(a), int(b)) for a, b in draw.integers(0, 90, size=(400, 2))} | {(7, i) for i in range(208)}
    seen = spark.createDataFrame([(f"q{a}", f"i{b}") for a, b in sorted(banned)], "query_id string, item_id string")
    tables = frame(spark, q, "q{}".format, kind), frame(spark, x, "i{}".format, kind)
    for digits in (9, None):
        found = best_products(*tables, 5, seen=seen, digits=digits, rows_per_block=8).collect()
        assert {(r["query_id"], r["item_id"], r["rank"]) for r in found} == brute(q, x, 5, 9, banned)


def test_near_ties_are_ordered_in_double_precision(spark):
    # The second half of the numbers is below what single precision tells apart.
    x = 1 + np.arange(300)[:, None] * 1e-8 + np.zeros((300, 3))
    items = frame(spark, np.random.default_rng(1).permutation(x), "i{}".format, "double")
    ordered = best_products(frame(spark, np.ones((2, 3)), "q{}".format, "double"), items, 4, rows_per_block=16)
    best = np.round(3 * x[-4:, 0][::-1], 9)
    assert [r["score"] for r in ordered.orderBy("query_id", "rank").collect()] == pytest.approx([*best, *best], abs=1e-9)


def test_vectors_are_not_repeated_for_each_cell(spark):
    x = np.random.default_rng(2).normal(size=(600, 4))
    sides = frame(spark, x, "i{}".format)
    found = best_products(sides, sides, 3, exclude_self=True, rows_per_block=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" in plan
    assert found.count() == 1800


def test_null_vectors_empty_sides_and_lone_items(spark):
    some = spark.createDataFrame([("b", [1.0, 2.0]), ("c", None)], "id string, vector array<double>")
    assert best_products(some.limit(0), some, 2).count() == 0
    assert best_products(some, some.limit(0), 2).count() == 0
    found = best_products(some, some, 2).collect()
    assert [(r["query_id"], r["item_id"], r["score"]) for r in found] == [("b", "b", 5.0)]
