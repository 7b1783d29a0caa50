import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gradeloom.session import build_session

SF = "/root/testdata/sf0.001"
# A failed task reaches Python as one or the other.
FAILED = (PySparkException, Py4JJavaError)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.log.level": "ERROR"})
    yield session
    session.stop()
