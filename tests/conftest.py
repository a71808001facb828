import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from textloom.session import build_session

    s = build_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(tmp_path):
    return str(tmp_path)
