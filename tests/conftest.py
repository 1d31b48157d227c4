import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from riskframe.session import local_session

SF = os.environ.get("RISKFRAME_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def tx(spark, sf):
    from riskframe.sources import canonical

    return canonical.transactions(spark, sf)
