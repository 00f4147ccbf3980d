"""Every registered query against its SQL text in a second engine."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from portpulse.plans.catalog import QUERIES
from portpulse.plans.oracle import ORACLE

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, other, name):
    df = QUERIES[name](spark, SF_DIR)
    result = other.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert as_rows(df.columns, df.collect()) == as_rows(result.columns, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
