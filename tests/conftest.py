import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from workload.check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session("8", 8)


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("SF_DIR", "/root/testdata/sf0.01")
