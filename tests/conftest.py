import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session("4", 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
