import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def lines(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")
