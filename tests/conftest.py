import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helpers import SF_DIR  # noqa: E402
from topicmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny(spark):
    rows = [(1, "Red red blue"), (2, "blue, green!"), (3, "école x 42"), (4, "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.fixture(scope="session")
def matrix(spark):
    """Dictionary and TF-IDF matrix of the small documents table."""
    from topicmill.plans import catalog

    return catalog.vector_table(spark, SF_DIR)
