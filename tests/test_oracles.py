import pytest
from sf_paths import SF_DIR

from checks import all_queries
from checks.compare import compare, oracle_connection

QUERIES, ORACLES = all_queries()
# their operators have tests of their own; python -m checks.compare runs them
SLOW = {"train_binary", "train_multiclass", "train_regression", "tune_single", "tune_multi", "model_compare"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_its_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_flagship(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows and all(0 <= r["default_rate"] <= 1 for r in rows)
