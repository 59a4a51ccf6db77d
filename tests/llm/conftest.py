import pytest

from curaspark.llm import common


@pytest.fixture(autouse=True)
def own_splits(spark):
    """Queries and the pipeline pin the session's file splits; the session is shared, and each test finds and leaves it unpinned."""
    spark.conf.unset(common.SPLITS)
    yield
    spark.conf.unset(common.SPLITS)
