from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from cartpath.llm import warc
from cartpath.session import work_path


def digest(html) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    top = {}
    for page_id, _, html in rows:
        if page_id is not None:
            top[html or ""] = max(page_id, top.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        size, best = len((html or "").encode()), top.get(html or "")
        revisit = size >= least and page_id != best
        out.append((page_id, size, digest(html), "revisit" if revisit else "response", best if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 5])
def test_edge_rows(spark, least):
    tricky = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(1, "http://a/", tricky), (2, "http://b/\r\nWARC-Type: response", tricky), (3, None, None), (4, "u", ""), (None, "n", "same"), (5, "s", "same")]
    rows += [(6, "é", "é" * 20_000), (7, "d", "again"), (7, "d", "again"), (8, "e", "\n\n"), (9, "f", "\r\n\r\n")] + [(20 + i, "h", "hot page") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = work_path(spark, "warc")
    warc.write_archives(warc.records(pages, least), path, records_per_file=40)
    nested = warc.captures(warc.read_records(spark, path))
    assert Counter(tuple(r) for r in warc.page_captures(nested).collect()) == expected(rows, least)
    one = nested.where("metadata.content LIKE 'page-id: 6\r%'").first()
    assert (one.response.payload.decode(), one.response.target_uri, one.request.target_uri) == ("é" * 20_000, "é", "é")


def test_given_pages(spark):
    from cartpath.llm.queries import archives

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert Counter(tuple(r) for r in archives(spark, folder).collect()) == expected(rows)


def test_foreign_archives():
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nwarc-record-id: <a>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    other = record.replace(b"<a>", b"<b>")
    for data in (record + other, gzip.compress(record) + gzip.compress(other), gzip.compress(record + other)):
        assert [(r[0], r[1], r[7]) for r in warc.parse(data)] == [("<a>", "resource", b"hello"), ("<b>", "resource", b"hello")]


def test_empty_table(spark):
    assert warc.records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
