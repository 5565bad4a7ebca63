"""Archives, index and range reads: exact round trips, and the records against the input."""
import base64
import gzip
import hashlib
import io
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from llm import queries, warc

SF = Path("/root/testdata/sf0.001")
DDL = "page_id long, url string, html string, kind string, key int"
BODY = "<p>été\r\n\r\nWARC/1.1\r\n</p>"
ROWS = ([(k, f"https://a{k % 3}.Example.com/x/{k}?q=1#t", f"page {k} " * 50) for k in range(40)] + [(100 + k, f"http://b.example.org/{k}", BODY) for k in range(30)]
        + [(3, "http://other/", BODY), (None, "no scheme", BODY), (None, None, None), (7, None, None), (8, "", ""), (9, "ftp://x\r\ny/\nz", "\0\r\n\0"), (10, "http://h/" + "p" * 5000, "q" * 200_000),
           (11, "http://same/", "one"), (11, "http://same/", "one"), (11, "http://same/", "two"), (12, "http://same/", "one")])


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], DDL).repartition(3)


def expected():
    groups = {}
    number = lambda i: warc.NO_ID if i is None else i
    for i, _, html in ROWS:
        groups[html or ""] = min(groups.get(html or "", warc.NO_ID), number(i))
    out = []
    for i, url, html in ROWS:
        raw, first = (html or "").encode(), groups[html or ""]
        again = first != number(i)
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        url = url and url.replace("\r", "%0D").replace("\n", "%0A")
        out.append((str(i), str(url), "revisit" if again else "response", sha, len(raw), first if again else None, None if again else raw))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def folder(pages):
    return warc.write(warc.records(pages))


@pytest.fixture
def index(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "PART_LINES", 20)
    monkeypatch.setattr(warc, "BLOCK_LINES", 7)
    return warc.build_index(warc.captures(spark, folder))


def keys(pages):
    return pages.select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))


@pytest.mark.parametrize(("limit", "direct"), [(1 << 20, True), (0, True), (1 << 20, False)])
def test_every_page_is_found(pages, folder, index, limit, direct):
    assert index.count() > 10
    got = warc.read_ranges(warc.lookup(index, keys(pages).union(keys(pages)), limit), folder, direct).collect()
    seen = [(str(r.id), str(r.url), r.kind, r.digest, r.payload_bytes, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(seen, key=str) == expected()


def test_scan_by_spark_and_directly(spark, folder):
    lines = [sorted(map(tuple, warc.captures(spark, folder, direct).collect()), key=str) for direct in (True, False)]
    assert lines[0] == lines[1] and len(lines[0]) == len(ROWS)


def test_missing_keys_and_few_keys_at_once(spark, pages, index, monkeypatch):
    monkeypatch.setattr(warc, "KEYS_AT_ONCE", 2)
    asked = keys(pages).union(spark.createDataFrame([("a",), ("zz",), ("com,example,a1)/x/", ), (None,)], "key string"))
    assert warc.lookup(index, asked).count() == len(ROWS)
    assert warc.lookup(index, asked.filter("key IN ('a', 'zz')")).count() == 0


def test_files_are_archives(spark, folder):
    """Plain gzip reads them, and each record's range is a member that stands alone."""
    for row in warc.archives(spark, folder).select("path", "content").collect():
        data = bytes(row.content)
        if not data:
            continue
        whole = gzip.decompress(data)
        records = list(warc.scan(io.BytesIO(data), 100))
        assert b"".join(r for _, _, r in records) == whole
        assert [gzip.decompress(data[at:at + size]) for at, size, _ in records] == [r for _, _, r in records]
        assert sum(size for _, size, _ in records) == len(data)


@pytest.mark.parametrize("size", [1, 17, 1 << 20])
def test_long_records_take_several_members(size):
    record = bytes(random.Random(1).randbytes(5000))
    coded = warc.members(record, size)
    assert gzip.decompress(coded) == record and coded[-1] == 0


def test_truncated_archives_are_refused():
    row = {"payload": "x" * 999, "payload_bytes": 999, "kind": "response", "id": 1, "url": "u", "digest": "D", "refers_to": None}
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.scan(io.BytesIO(warc.members(warc.record_bytes(row))[:-9])))


def test_small_payloads_are_all_responses(pages):
    kinds = warc.records(pages, min_bytes=10).filter("payload_bytes < 10").groupBy("kind").count().collect()
    assert [r.kind for r in kinds] == ["response"]


def test_empty_table(spark, pages):
    none = warc.write(warc.records(pages.limit(0)))
    index = warc.build_index(warc.captures(spark, none))
    assert index.count() == 0
    assert warc.read_ranges(warc.lookup(index, keys(pages)), none).count() == 0


def test_keys_lie_by_site(spark):
    rows = spark.createDataFrame([("https://www.Example.com/A?b#c", 5), (None, None), ("x", 1)], "u string, i long").select(warc.capture_key(F.col("u"), F.col("i"))).collect()
    assert [r[0] for r in rows] == ["com,example,www)/A?b#c 00000000000000000005", ") 0000000000000000000-", ")x 00000000000000000001"]


def test_query_equals_sql(spark):
    got = queries.QUERIES["op11_warc"](spark, str(SF))
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS FROM read_parquet('{SF}/pages.parquet')")
    want = duckdb.sql(queries.ORACLE["op11_warc"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
