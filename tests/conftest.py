import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surveyloom.fixtures.respondents import respondents  # noqa: E402
from surveyloom.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "surveyloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def silver(spark, tmp_path_factory):
    """The conformed rows, stored once for all tests."""
    path = str(tmp_path_factory.mktemp("silver") / "rows")
    respondents(spark, TESTDATA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, for comparison."""

    def collect(frame, *columns):
        picked = [tuple(row) for row in frame.select(*(columns or frame.columns)).collect()]
        return sorted(picked, key=lambda row: tuple((value is None, str(value)) for value in row))

    return collect
