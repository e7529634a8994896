"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry_points
from weekloom.plans import oracles, registry

from .compare import duck, duck_result, duck_types, spark_result, spark_types

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = oracles.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns, rows = spark_result(df)
    want_columns, want = duck_result(con, SQL[name])
    assert columns == want_columns
    assert spark_types(df) == duck_types(con, SQL[name])
    assert rows == want and rows


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10
