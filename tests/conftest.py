import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from screenmeld.session import ROWS_PER_TASK_KEY, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, 8)
    yield session
    session.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Force the split path of ordered operators."""
    spark.conf.set(ROWS_PER_TASK_KEY, "25")
    yield
    spark.conf.unset(ROWS_PER_TASK_KEY)
