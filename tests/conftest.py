import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
CHECK_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    """A fresh folder per test (pytest makes a new one each time)."""
    return str(tmp_path)
