"""Queries of the package against their SQL in DuckDB."""

import pytest

from weekloom.llm import oracles, queries

from ..compare import duck, duck_result, duck_types, spark_result, spark_types

SQL = oracles.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, name):
    con = duck(folder)
    df = queries.queries()[name](spark, folder)
    columns, rows = spark_result(df)
    want_columns, want = duck_result(con, SQL[name])
    assert columns == want_columns and rows == want and rows
    assert spark_types(df) == duck_types(con, SQL[name])
