import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bloomledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, app="bloomledger-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def apply(spark):
    """Evaluate a column function over a list of texts, in order."""

    def run(function, values, schema="value string"):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, {schema}")
        out = frame.select("i", function(frame["value"]).alias("out")).orderBy("i")
        return [r["out"] for r in out.collect()]

    return run
