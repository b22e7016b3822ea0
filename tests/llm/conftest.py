import pytest
from pyspark.sql import SparkSession


@pytest.fixture
def docs(spark: SparkSession):
    """Documents from (doc_id, text[, source]) tuples, with further columns whose names operators use inside."""

    from adlake.llm.common import start

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), 7, "x") for r in rows]
        return start(spark).createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, size long, id string"
        )

    return make
