"""Every registered query with SQL equals it on the smallest data set."""

import os

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def connection():
    return connect(SMOKE_DIR)


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() == 1


# Full-size fits that take minutes on any data; test_models runs the same jobs with small settings.
SLOW = {"als_grid_search", "training_job"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    if name in SLOW and not os.environ.get("RANKLIGHT_SLOW"):
        pytest.skip("set RANKLIGHT_SLOW to run the full-size fits")
    result, _, _ = compare(spark, connection, SMOKE_DIR, queries()[name], oracle_sql()[name])
    assert result == "equal"
