"""Every registered query that has SQL, against it, on a whole small input."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from compare import compare_one
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n in entry.queries()])
def test_query_equals_sql(spark, con, name):
    ok, told = compare_one(spark, con, name, str(DATA))
    assert ok, told


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
