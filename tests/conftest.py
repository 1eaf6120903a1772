import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weirflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4, **{"spark.sql.warehouse.dir": "/tmp/weirflow-tests-warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples."""

    def collect(frame, *columns):
        return sorted((tuple(r) for r in frame.select(*columns or frame.columns).collect()), key=repr)

    return collect
