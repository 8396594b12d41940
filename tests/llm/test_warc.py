import gzip
import hashlib
import io
from collections import defaultdict

import pytest

from shardsync.llm.common import work_dir
from shardsync.llm.warc import (
    archive_pages,
    assemble,
    choose_stored,
    parse_records,
    read_warc,
    write_warc,
)

BIG = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60
PAGES = [
    (1, "http://h/a", BIG), (2, "http://h/b", BIG), (7, None, BIG), (3, "http://h", "small"),
    (4, "http://h/c", "small"), (5, "x\r\ny", None), (6, "http://h/d", ""),
    (None, "http://h/e", BIG), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "y" * 1000),
    (11, "u", "y" * 1000), (12, "u", "z" * 3_000_000), (13, "u", BIG.upper()),
]


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS type", "'x' AS payload", "1 AS name", "2 AS digest")


def expected(rows):
    largest = defaultdict(list)
    for i, _, html in rows:
        largest[html or ""].append(i)
    for i, _, html in rows:
        data = (html or "").encode()
        keep = max(largest[html or ""], key=lambda x: (x is not None, x)) if len(data) >= 1000 else i
        own = keep == i
        yield i, len(data), hashlib.sha1(data).hexdigest(), "response" if own else "revisit", None if own else keep


def test_pages_come_back(spark):
    found = archive_pages(pages(spark, PAGES)).drop("capture").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected(PAGES)))


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", BIG), (1, "u", BIG), (2, "u", "s"), (2, "u", "s")]
    found = archive_pages(pages(spark, rows)).collect()
    assert sorted((r.page_id, r.record_type) for r in found) == [
        (1, "response"), (1, "revisit"), (2, "response"), (2, "response"),
    ]
    assert archive_pages(pages(spark, PAGES).limit(0)).count() == 0


def test_captures_are_nested(spark):
    files = write_warc(choose_stored(pages(spark, PAGES[:4])), work_dir(spark, "w"))
    records = read_warc(files, batch_bytes=1)
    rows = assemble(records, "block").collect()
    assert len(rows) == 4
    for r in rows:
        assert r.request.type == "request" and r.metadata.type == "metadata"
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.response.record_id == r.capture
        assert bytes(r.response.block).startswith(b"HTTP/1.1 200")


def test_partners_that_are_missing_or_repeat(spark):
    kind = (
        "file string, position long, record_id string, type string, concurrent_to string, refers_to string,"
        " target_uri string, warc_date string, payload_digest string, content_type string"
    )

    def row(position, name, kind, to=None):
        return ("f", position, name, kind, to, None, None, None, None, None)

    rows = [
        row(0, "r1", "response"), row(1, "q1", "request", "r1"), row(2, "q2", "request", "r1"),
        row(3, "m9", "metadata", "r9"), row(4, "r2", "revisit"), row(4, "r2", "revisit"),
        row(5, "w", "warcinfo"), row(6, "q3", "request", None),
    ]
    found = {r.capture: r for r in assemble(spark.createDataFrame(rows, kind)).collect()}
    assert set(found) == {"r1", "r2", "r9"}
    assert found["r1"].request.record_id == "q1" and found["r1"].metadata is None
    assert found["r9"].response is None and found["r9"].metadata.record_id == "m9"
    assert found["r2"].request is None


def test_parser_reads_folded_headers_plain_files_and_refuses_cut_ones(spark, tmp_path):
    raw = b"WARC/1.0\r\nWARC-Type: resource\r\nX: a\r\n b\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    headers, block = next(parse_records(io.BytesIO(raw)))
    assert headers["x"] == "a b" and block == b"\r\n\r\n"
    with pytest.raises(ValueError):
        list(parse_records(io.BytesIO(raw[:-7])))
    for name, data in (("p.warc", raw * 2), ("z.warc.gz", gzip.compress(raw) * 2)):
        (tmp_path / name).write_bytes(data)
        files = spark.createDataFrame([(str(tmp_path / name),)], "file string")
        assert [r.type for r in read_warc(files).collect()] == ["resource"] * 2
