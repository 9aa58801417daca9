import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session
    s = build_session("local[*]", 8, app_name="tessera-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
