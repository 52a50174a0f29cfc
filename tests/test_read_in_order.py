"""The loans written in order and read back: the write is split as the shuffle is, not into a fixed few parts."""

from checks import all_queries
from checks.cleaning import _read_in_order
from checks.compare import compare, oracle_connection

QUERIES, ORACLES = all_queries()


def test_written_in_more_parts_than_six_and_equal_to_sql(spark, sf_dir):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for kind in ("parquet", "csv"):
            read = _read_in_order(spark, sf_dir, kind)
            assert len(read.inputFiles()) > 6, kind
        con = oracle_connection(sf_dir)
        for name in ("dedup_default_parquet", "dedup_default_csv"):
            assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
