import pytest
from odd_rows import ODD

from tabsmith.llm.common import prepare


@pytest.fixture
def frame(spark):
    """documents-like rows (doc_id, text) with an extra column that has the name of an internal one."""
    prepare(spark)

    def make(rows, parts=3):
        kind = "doc_id long, text string, lang string, lines string, fp string, __x int"
        full = [(i, t, "en", "l", "f", 1) for i, t in rows]
        return spark.createDataFrame(full, kind).repartition(parts)

    return make


@pytest.fixture
def odd(frame):
    return frame(ODD)
