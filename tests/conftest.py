from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL_SF = os.environ.get("TOKOLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tokoledger.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="tokoledger-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf() -> str:
    return SMALL_SF
