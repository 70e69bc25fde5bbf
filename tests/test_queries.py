"""Every registered query against its SQL; those without run and yield rows."""

import pytest

import __spark_entry__ as driver
from textspark.registry import ORACLES, QUERIES
from textspark.registry.compare import connect, difference

MAY_BE_EMPTY = {"labels_missing"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_all_are_registered():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        "grid_search", "grid_best", "compare_features", "softmax_fit", "quality_fit", "graph_classifier",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, sf_dir, QUERIES[name], ORACLES[name]) == ""
    assert name in MAY_BE_EMPTY or duck.execute(ORACLES[name]).fetchone() is not None


@pytest.mark.parametrize("name", ["grid_search", "grid_best", "compare_features", "quality_fit", "graph_classifier"])
def test_yields_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "dev", "test"}
