"""Every query with SQL agrees with DuckDB; the others return rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare
from workload.registry import TABLES

SMALL = "/root/testdata/sf0.001"
MODELS = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    assert compare(spark, con, SMALL, name).startswith("same")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(MODELS) <= {"whole_preparation", "preparation_report"} | {m for m in MODELS if m.startswith(("op", "pipeline"))}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
