"""Every registered query against its SQL counterpart on the given tables."""

from __future__ import annotations

import pytest
from compare import kinds, oracle, oracle_rows, spark_rows

import __spark_entry__ as driver
from cartpath.plans import oracle as counterparts
from cartpath.plans import queries as registered

QUERIES = registered.queries()
SQL = counterparts.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.01"])
def scale(request):
    folder = f"/root/testdata/{request.param}"
    return folder, oracle(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, scale, name):
    folder, connection = scale
    columns, rows = spark_rows(QUERIES[name](spark, folder))
    expected_columns, expected = oracle_rows(connection, SQL[name])
    assert columns == expected_columns
    assert rows == expected
    assert [kinds(r) for r in rows] == [kinds(r) for r in expected]
    assert rows


def test_entry(spark):
    rows = driver.entry(spark)
    assert len(rows.columns) == 38
    assert rows.count() == 150
