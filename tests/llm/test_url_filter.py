from __future__ import annotations

import datetime as dt

import pytest
from compare import oracle_rows, spark_rows

from cartpath.llm import url_filter
from cartpath.llm.oracle import oracle_sql
from cartpath.llm.queries import queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("pages", "documents"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{table}.parquet')")
    assert spark_rows(queries()[name](spark, "/root/testdata/sf0.01")) == oracle_rows(connection, oracle_sql()[name])


def test_intervals_and_matches(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    changes = [
        ("ads", "x.example", day(10), True), ("ads", "x.example", day(20), False), ("ads", "x.example", day(20), False),
        ("ads", "x.example", day(30), True), ("bad", "a.x.example/p/", day(15), True), ("bad", None, day(1), True),
        ("bad", "y.example", None, True), ("bad", "z.example", day(5), False), ("bad", "z.example", day(5), True),
    ]
    captures = [
        (1, "http://a.x.example/p/q?r", day(9)), (2, "HTTP://u@A.X.example:80/p/q", day(10)), (3, "http://a.x.example/p/q", day(16)),
        (4, "http://a.x.example/p", day(19)), (5, "http://x.example", day(20)), (6, "http://x.example", day(99)),
        (7, "http://notx.example/", day(99)), (8, None, day(99)), (9, "http://x.example", None), (10, "", day(1)),
        (11, "http://z.example/", day(5)), (6, "http://x.example", day(99)), (12, "http://a.x.example/p/", day(16)),
    ]
    made = url_filter.filter_captures(
        spark.createDataFrame(captures, "page_id long, url string, fetched_on date").selectExpr("*", "1 AS entry", "2 AS blocked"),
        spark.createDataFrame(changes, "list_name string, entry string, changed_on date, is_active boolean"),
    )
    got = sorted((r.page_id, r.blocked, r.list_name, r.n_entries) for r in made.collect())
    assert [g for g in got if g[1]] == [
        (2, True, "ads", 1), (3, True, "ads", 2), (4, True, "ads", 1), (6, True, "ads", 1), (6, True, "ads", 1), (11, True, "bad", 1), (12, True, "ads", 2),
    ]
    assert len(got) == len(captures)
