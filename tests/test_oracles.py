"""Every registered query against its SQL form, on the smallest tables."""

import check_oracles
import pytest

from tabmill.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracles.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert check_oracles.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["k01_kmeans", "k13_small", "k18_l14_score_batch"])
def test_query_without_sql(spark, name):
    found = [n for n in QUERIES if n == name or name == "k13_small" and n == "k05_k13_model_compare_small"]
    assert QUERIES[found[0]](spark, FOLDER).count() > 0


def test_sql_only_for_registered_queries():
    assert set(ORACLES) <= set(QUERIES)
