from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session(master="local[*]", shuffle_partitions=8, app_name="tidemark-tests", driver_memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
