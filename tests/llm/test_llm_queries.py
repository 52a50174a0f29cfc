import pytest

from checks.compare import compare, oracle_connection
from tabsmith.llm.queries import all_queries

QUERIES, ORACLES = all_queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_document(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert "doc_id" in rows.columns


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
