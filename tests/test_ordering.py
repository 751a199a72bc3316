import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from ranklight.operators.ordering import (
    add_range,
    dense_ids,
    exact_quantile,
    row_numbers,
    running_sums,
    top_n,
)


DRAWN = {
    "narrow": lambda rng: rng.uniform(0.5, 0.6),
    "a year of seconds": lambda rng: float(rng.randint(1_700_000_000, 1_731_536_000)),
    "heavy tail": lambda rng: rng.choice((-1, 1)) * rng.paretovariate(0.3),
    "wide": lambda rng: rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300),
}


@pytest.mark.parametrize("name", DRAWN)
def test_ranges_keep_the_order_and_are_even(spark, name):
    rng = random.Random(1)
    values = {DRAWN[name](rng) for _ in range(8000)}
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranged = add_range(df, "v", ranges=100)
    assert ranged.columns == ["v", "_range"]
    found = [r["_range"] for r in sorted(ranged.collect(), key=lambda r: r["v"])]
    assert found == sorted(found)
    sizes = [found.count(b) for b in range(100)]
    assert sum(sizes) == len(values) and max(sizes) <= 2 * len(values) / 100 and min(sizes) > 0


def test_ranges_of_odd_values_and_by_key(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", v) for v in (nan, inf, -inf, 0.0, -0.0, None, 5.0, 1e300)]
    rows += [("b", float(v)) for v in range(1000)] + [("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = add_range(df, "v", "k", ranges=8).collect()
    assert all((r["v"] is None) == (r["_range"] is None) for r in found)
    own = sorted((r for r in found if r["k"] == "a" and r["v"] is not None), key=lambda r: (r["v"] != r["v"], r["v"]))
    assert [r["_range"] for r in own] == sorted(r["_range"] for r in own)
    assert len({r["_range"] for r in own if r["v"] == 0}) == 1
    sizes = [sum(r["k"] == "b" and r["_range"] == n for r in found) for n in range(8)]
    assert max(sizes) <= 2 * 1000 / 8 and sum(sizes) == 1000
    assert add_range(df.limit(0), "v", "k").count() == 0
    one = add_range(df.filter("v = 5"), "v").first()
    assert one["_range"] is not None


def test_running_sums_with_one_hot_key(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 5)}", t, rng.randint(0, 9)) for t in range(2000)]
    df = spark.createDataFrame(rows, "key string, t long, v long")
    out = running_sums(df, ["key"], F.floor(F.col("t") / 37), ["t"], {"seen": F.col("v")}, totals=True)
    got = {(r["key"], r["t"]): (r["seen"], r["seen_total"]) for r in out.collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == key)
        sums = list(accumulate(r[2] for r in mine))
        for row, total in zip(mine, sums):
            assert got[(key, row[1])] == (total, sums[-1])


def test_rows_without_a_bucket_come_first_and_are_kept(spark):
    df = spark.createDataFrame([("a", None), ("a", 5), ("a", 900)], "key string, t long")
    out = row_numbers(df, ["key"], F.floor(F.col("t") / 100), ["t"])
    assert {(r["t"], r["position"]) for r in out.collect()} == {(None, 1), (5, 2), (900, 3)}


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(3)
    values = [round(rng.uniform(-50, 50), 2) for _ in range(501)] + [7.5] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    at = (len(values) - 1) * q
    ordered = sorted(values)
    low, high = ordered[int(at)], ordered[min(int(at) + 1, len(values) - 1)]
    assert exact_quantile(df, "v", q).first()["quantile"] == pytest.approx(low + (high - low) * (at - int(at)))


def test_exact_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantile(df, "v", 0.5).first()["quantile"] is None


def test_dense_ids_are_a_permutation(spark):
    df = spark.createDataFrame([(f"id{i % 300}",) for i in range(900)], "name string")
    out = dense_ids(df, "name", "index").collect()
    assert sorted(r["index"] for r in out) == list(range(300))
    assert len({r["name"] for r in out}) == 300


def test_top_n_limits_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    ranked = top_n(df, ["k"], [F.desc("v")], 2)
    assert {(r["k"], r["v"], r["rank"]) for r in ranked.collect()} == {
        (0, 999, 1), (0, 996, 2), (1, 997, 1), (1, 994, 2), (2, 998, 1), (2, 995, 2)
    }
    plan = ranked._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_the_input_of_running_sums_is_computed_once(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    out = row_numbers(df, ["k"], F.floor(F.col("t") / 100), ["t"])
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
