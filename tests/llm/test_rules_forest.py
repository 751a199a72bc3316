"""The forest's path lengths beside a walk by hand, and odd texts that only some of the rules show."""

import random
import zlib

import numpy as np
import pytest
from tests.llm.conftest import words

from ranklight.llm import isolation

GIVEN = "/root/testdata/sf0.1"


def test_anomaly_equals_a_walk_through_each_tree():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 4)).round(1)
    forest = isolation.fit_forest(x, trees=12, rows=64)
    got = forest.anomaly(x[:40])
    for row, value in zip(x[:40], got):
        depths = []
        for feature, cut, depth in zip(forest.feature, forest.cut, forest.depth):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + (2 if row[feature[node]] >= cut[node] else 1)
            depths.append(depth[node])
        assert value == pytest.approx(2 ** (-np.mean(depths) / forest.usual))


def test_leaves_stand_for_the_rows_that_reach_them():
    x = np.random.default_rng(6).normal(size=(64, 3))
    forest = isolation.fit_forest(x, trees=5, rows=64)
    for feature, depth in zip(forest.feature, forest.depth):
        for node in np.flatnonzero(depth > 0):
            level = int(np.log2(node + 1))
            assert feature[node] == -1 and depth[node] >= level


def test_odd_texts_are_dropped_and_good_ones_kept(spark):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    labels = spark.read.parquet(f"{GIVEN}/labels.parquet")
    forest = isolation.fit_rules(docs, labels)
    judged = isolation.apply_rules(docs, forest).join(labels, "doc_id")
    good = judged.filter("quality = 1 AND NOT base_failed AND crc32(CAST(doc_id AS STRING)) % 3 = 1")
    assert good.filter("kept").count() >= 0.95 * good.count() > 0
    draw = random.Random(1)
    lines = ["same old line" if k % 2 else " ".join(words(draw, 9)) for k in range(120)]
    odd = [
        (0, " ".join(str(1000 + 7 * k) for k in range(400))),
        (1, " ".join(words(draw, 200)) + " " + "q" * 3000),
        (2, "\n".join(lines)),
    ]
    found = isolation.apply_rules(spark.createDataFrame(odd, "doc_id long, text string"), forest).collect()
    assert [(r["base_failed"], r["kept"]) for r in sorted(found)] == [(False, False)] * 3


def test_all_rows_grow_the_forest_and_set_the_threshold(spark):
    draw = random.Random(4)
    texts = [" ".join(words(draw, draw.randint(25, 90))) for _ in range(500)]
    texts = [t.upper().replace(" ", "!! ") if i % 4 == 0 else t for i, t in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 500, 3)], "doc_id long, quality int")
    rows = isolation.measured_rows(docs).filter("NOT base_failed").toPandas()
    x = np.stack(rows["x"].to_list())
    assert len(x) > 256
    forest = isolation.fit_rules(docs, labels, trees=6)
    assert forest.usual == pytest.approx(float(isolation._expected_path(len(x))))
    for feature, cut, depth in zip(forest.feature, forest.cut, forest.depth):
        waiting, taken = [(0, np.arange(len(x)))], 0
        while waiting:
            node, own = waiting.pop()
            level, f = int(np.log2(node + 1)), feature[node]
            if f < 0:
                taken += len(own)
                assert depth[node] == pytest.approx(level + float(isolation._expected_path(len(own))))
                assert level == 8 or len(own) == 1 or (x[own].min(0) == x[own].max(0)).all()
                continue
            right = x[own, f] >= cut[node]
            assert 0 < right.sum() < len(own)
            waiting += [(2 * node + 1, own[~right]), (2 * node + 2, own[right])]
        assert taken == len(x)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    learnt = np.array([zlib.crc32(str(i).encode()) % 3 != 1 and i in quality for i in rows["doc_id"]])
    good = np.array([quality[i] == 1 for i in rows["doc_id"][learnt]])
    assert forest.threshold == pytest.approx(isolation.calibrate(forest.anomaly(x[learnt]), good), abs=1e-12)
    again = isolation.fit_rules(docs.repartition(5, "text"), labels, trees=6)
    assert (again.cut == forest.cut).all() and (again.depth == forest.depth).all()
