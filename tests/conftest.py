import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siltline import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="siltline-tests-")
    session = build_session(
        "tests", "local[8]", 8,
        {"spark.ui.enabled": "false", "spark.checkpoint.dir": shared, "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    """A folder of its own for each test."""
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf():
    return SF_DIR
