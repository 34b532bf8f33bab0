import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hiremart.session import local_session

    s = local_session(4, shuffle_partitions=4, app="hiremart-tests")
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="hiremart-test-", dir="/tmp")
