"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from stationcast.plans import catalog, oracles
from tests import compare

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = catalog.queries(), oracles.oracle_sql()
ROWS_ONLY = {"train_temperature", "train_precipitation", "train_condition", "grid_search",
             "learning_curves", "feature_importances", "batch_forecast"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


def test_names_agree():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) == []


def test_the_whole_search_and_a_forecast(spark):
    """All candidates of all targets over the whole folder, and what is served from the best."""
    trials = QUERIES["grid_search"](spark, FOLDER).collect()
    assert len(trials) == 30 and {t.rank for t in trials} == set(range(1, 11))
    assert len({(t.target, t.score) for t in trials}) == 30         # no two candidates fit the same
    for name in sorted(ROWS_ONLY - {"grid_search"}):
        assert not QUERIES[name](spark, FOLDER).isEmpty(), name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
