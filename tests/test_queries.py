"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import ROOT, connect, spark_rows, sql_rows

from tidemark.plans import REGISTRY

FOLDER = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    cols, got = spark_rows(name, spark, FOLDER)
    assert len(cols) == len(set(cols))
    if REGISTRY[name].sql is None:
        assert got
        return
    want_cols, want = sql_rows(name, con)
    assert cols == want_cols
    assert got == want
