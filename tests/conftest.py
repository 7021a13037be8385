from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from tests.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
