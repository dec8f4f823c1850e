"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark():
    from paperloom.session import local_session

    session = local_session("8", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from paperloom.session import cleanup

    cleanup()


@pytest.fixture(scope="session")
def small():
    """The smallest driver tables; tests on them are skipped where they are absent."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no driver tables here")
    return folder
