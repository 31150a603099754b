import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarnwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tarnwork-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture()
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *cols):
        data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(data, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))

    return collect
