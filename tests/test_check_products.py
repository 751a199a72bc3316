"""The products that scores are checked against."""

from checks.queries import _products
from ranklight.operators.collaborative import CollaborativeModel


def test_products_of_known_pairs_without_a_row_for_each_number(spark):
    users = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, -1.0])], "user_id long, vector array<float>")
    items = spark.createDataFrame([(7, [3.0, 4.0])], "item_id long, vector array<float>")
    pairs = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (2, 8), (3, 7)], "user_id long, item_id long")
    found = _products(CollaborativeModel(users, items, pairs), pairs)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 7, 11.0), (2, 7, -2.5)]
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
