import os
import sys

import pytest
from pyspark import cloudpickle

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog import session  # noqa: E402


def pytest_collection_modifyitems(items):
    # steps defined in test modules have to reach the workers, too
    for module in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(module)


@pytest.fixture(scope="session")
def spark():
    s = session.open_session("tests", **{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "3",
        "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(params=["plain", "sliced"])
def layout(request, monkeypatch):
    """Run a test with whole histories, and with every history cut into slices."""
    if request.param == "sliced":
        monkeypatch.setattr(session, "ROWS_PER_TASK", 0)
        monkeypatch.setattr(session, "ROWS_PER_SLICE", 2)
    return request.param
