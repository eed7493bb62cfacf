import gzip
import hashlib

import pytest
from compare import duckdb_result, open_tables, spark_result
from pyarrow import fs

from millrace.llm import warc
from millrace.llm.queries import QUERIES, SQL
from millrace.session import scratch_path


def test_equals_sql(spark, sf_dir):
    got = spark_result(QUERIES["op4_warc"](spark, sf_dir))
    assert got == duckdb_result(open_tables(sf_dir), SQL["op4_warc"])


@pytest.fixture
def pages(spark):
    big = "".join(f"<p>{i} é</p>\r\n\r\n" for i in range(5000))
    rows = [
        (5, "http://a/é b\r\nX: y", big), (3, None, big), (9, "u", "x" * 99), (10, "u", "x" * 99), (11, "u", "y" * 100),
        (12, "u", "y" * 100), (12, "u", "y" * 100), (11, "u", "y" * 100), (1, "u", None), (2, "u", ""), (None, "u", "y" * 100),
        (None, "u", "z" * 100), (None, "u", "z" * 100),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_bytes string")


@pytest.mark.parametrize("chunk", [7_000, 1 << 20])
def test_round_trip(spark, pages, chunk):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(warc.record_table(pages, chunk_bytes=chunk), folder, archive_bytes=50_000)
    assert manifest.agg({"records": "sum"}).first()[0] == 13
    rows = warc.read_warc(spark, manifest, chunk_bytes=chunk).collect()
    assert max(len(r.content or b"") for r in rows) <= chunk
    want = sorted(((p.page_id, (p.html or "").encode()) for p in pages.collect()), key=str)
    ends = [r for r in rows if r.is_last]
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest) for r in ends), key=str) == sorted(
        ((i, len(b), hashlib.sha256(b).hexdigest()) for i, b in want), key=str
    )
    by = {}
    for r in rows:
        if r.record_type == "response" and r.page_id is not None:
            by.setdefault(r.page_id, {})[r.chunk_no, len(by.get(r.page_id, {}))] = r.content
    assert b"".join(v for _, v in sorted(by[3].items())) == dict(want)[3]
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in ends), key=str)
    assert kinds == sorted([
        (3, "response", None), (5, "revisit", 3), (9, "response", None), (10, "response", None), (11, "response", None),
        (11, "response", None), (12, "revisit", 11), (12, "revisit", 11), (1, "response", None), (2, "response", None),
        (None, "revisit", 11), (None, "response", None), (None, "response", None),
    ], key=str)


def test_archives_are_plain_warc(spark, pages):
    folder = scratch_path(spark, "warc")
    manifest = warc.write_warc(warc.record_table(pages.filter("page_id = 11").limit(1)), folder).collect()
    with fs.FileSystem.from_uri(manifest[0].path)[0].open_input_stream(fs.FileSystem.from_uri(manifest[0].path)[1], compression=None) as f:
        text = gzip.decompress(f.read()).decode()
    head, http, body = text.split("\r\n\r\n")[:3]
    assert head.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and body == "y" * 100
    length = int(head.split("Content-Length: ")[1])
    assert length == len(http) + 4 + 100 and text.endswith("y\r\n\r\n")


def test_damage_is_found(spark, tmp_path):
    row = {"page_id": 1, "url": None, "record_type": "response", "refers_to": None, "payload_bytes": 3, "_last": 0, "chunk_no": 0}
    row |= {"payload_digest": hashlib.sha256(b"abc").hexdigest(), "content": b"abc"}
    archive = warc.Archive(str(tmp_path))
    archive.add(row, "1970-01-01T00:00:00Z")
    path = archive.close()["path"]
    good = gzip.decompress(open(path, "rb").read())
    for bad in (good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"), good[:-9]):
        open(path, "wb").write(gzip.compress(bad))
        with pytest.raises(ValueError), open(path, "rb") as f:
            list(warc.chunks_of(f, 100, True))


def test_empty_table(spark, pages):
    manifest = warc.write_warc(warc.record_table(pages.limit(0)), scratch_path(spark, "warc"))
    assert warc.read_warc(spark, manifest).count() == 0
