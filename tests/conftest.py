import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lectern.session import local_session

    s = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def clean():
    """What a test staged goes with it."""
    yield
    from lectern.session import clear_staged

    clear_staged()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
