"""Registered queries against their SQL, and that they are registered."""

import duckdb
import pytest

import __spark_entry__ as entry
from portpulse.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, name):
    other = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        other.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF_DIR), other.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=str)
    at = [want.columns.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries() and ORACLE.items() <= entry.oracle_sql().items()
