"""Queries with SQL against DuckDB."""

import pytest
from oracle import connect, rows_of

from tidemark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    found = connect(FOLDER).execute(SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in found.description], found.fetchall())


def test_names_of_queries():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
