"""Every registered query beside its SQL on DuckDB, at the smallest scale factor."""

import os

import pytest

from oracle import ROOT, compare, duck
from tidemark.queries import load

FOLDER = f"{ROOT}/sf{os.environ.get('TIDEMARK_TEST_SF', '0.001')}"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, FOLDER).columns
        return
    assert compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name]) == []
