import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sf_paths import SF_DIR  # noqa: E402

from tabsmith.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not here")
    return SF_DIR


@pytest.fixture
def values(spark):
    """Apply a column function to a list of values."""

    def run(fn, data, kind):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]

    return run
