from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("PITWALL_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pitwall.session import build_session

    s = build_session(master="local[8]", shuffle_partitions=8, app="pitwall-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    from pitwall.plans.compare import duckdb_connect

    return duckdb_connect(SF_ORACLE)
