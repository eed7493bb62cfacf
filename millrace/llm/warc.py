"""WARC archives by way of a chunked record table.

A payload goes to and comes from an archive as rows of (record, chunk number, bytes), never as a whole record: the
writer compresses chunk after chunk, the reader yields chunk after chunk, and both carry the digest along. Records
are gzip members of their own, as usual for `.warc.gz`. Each task writes archives under names of its own, and the
manifest lists only those of tasks that finished, so a lost executor leaves at most a file that nobody reads.

Archives lie in a folder that pyarrow's file systems reach from every executor (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import ready, whole_text
from millrace.plans.sizing import sized_join

CHUNK_BYTES = 64 << 10
ARCHIVE_BYTES = 1 << 30
# Payloads below this size are written as they are, even if equal.
REVISIT_BYTES = 100
READ_BYTES = 64 << 10
LEVEL = 1
RECORDS = uuid.uuid5(uuid.NAMESPACE_URL, "warc records of pages")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
CHUNKS = (
    "page_id long, url string, record_type string, refers_to long, chunk_no long, is_last boolean, "
    "content binary, payload_bytes long, payload_digest string"
)


def record_table(pages: DataFrame, payload: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Pages as chunk rows: of equal payloads of 100 bytes or more the smallest page_id is the response.

    Null payloads are empty; a null page_id never is the one that others refer to, unless all are null, and then
    each is a response; rows that repeat the smallest page_id are responses too. Other columns are not read.
    """
    content = whole_text(payload).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), content.alias("_p"))
    rows = rows.withColumns({"payload_bytes": F.length("_p").cast("long"), "payload_digest": F.sha2("_p", 256)})
    same = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest", "payload_bytes")
    firsts = same.agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    rows = sized_join(rows, firsts, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    rows = rows.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    last = F.when(revisit, 0).otherwise(F.floor((F.greatest("payload_bytes", F.lit(1)) - 1) / chunk_bytes)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), "_last"), lambda i: _part(revisit, i, chunk_bytes))
    return rows.withColumn("_last", last).select(
        "page_id", "url", "record_type", F.when(revisit, F.col("_first")).alias("refers_to"), "payload_bytes",
        "payload_digest", "_last", F.posexplode(parts).alias("chunk_no", "content"),
    )


def _part(revisit: Column, i: Column, chunk_bytes: int) -> Column:
    part = F.substring("_p", i * chunk_bytes + 1, F.lit(chunk_bytes))
    return F.when(revisit, F.lit(b"")).otherwise(part)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORDS, str(page_id))}>"


def headers(row: dict, date: str) -> bytes:
    """WARC header and HTTP header of a record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    revisit = row["record_type"] == "revisit"
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(row["page_id"]),
        "WARC-Date": date,
        "WARC-Target-URI": None if row["url"] is None else quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": record_id(row["refers_to"]) if revisit else None,
        "Page-Id": row["page_id"],
        "Refers-To-Page-Id": row["refers_to"],
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(http) + (0 if revisit else row["payload_bytes"]),
    }
    lines = [f"{name}: {value}\r\n" for name, value in fields.items() if value is not None]
    return f"WARC/1.1\r\n{''.join(lines)}\r\n{http}".encode()


class Archive:
    """One file being written, a gzip member per record."""

    def __init__(self, folder: str) -> None:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.path, self.records, self.bytes = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
        self.out = system.open_output_stream(f"{path}/{self.path.rsplit('/', 1)[1]}", compression=None)

    def write(self, data: bytes) -> None:
        self.bytes += len(data)
        self.out.write(data)

    def add(self, row: dict, date: str) -> None:
        if row["chunk_no"] == 0:
            self.member, self.digest = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), hashlib.sha256()
            self.write(self.member.compress(headers(row, date)))
        self.digest.update(row["content"])
        self.write(self.member.compress(row["content"]))
        if row["chunk_no"] == row["_last"]:
            if row["record_type"] == "response" and self.digest.hexdigest() != row["payload_digest"]:
                raise ValueError(f"chunks of page {row['page_id']} are not its payload")
            self.write(self.member.compress(b"\r\n\r\n") + self.member.flush())
            self.records += 1

    def close(self) -> dict:
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.bytes}


def write_warc(
    chunks: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record table as archives under `folder`; returns their manifest, computed."""
    ready(chunks.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if archive and row["chunk_no"] == 0 and archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
                archive = archive or Archive(folder)
                archive.add(row, date)
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(
            done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        )

    return chunks.mapInArrow(write, MANIFEST).checkpoint()


class Reader:
    """Bytes of a file of gzip members, a bounded part of them in memory."""

    def __init__(self, file) -> None:
        self.file, self.zip, self.raw, self.buffer = file, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Add to the buffer; False at the end of the file."""
        while True:
            if self.zip.eof:
                self.raw, self.zip = self.zip.unused_data or self.raw, zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.file.read(READ_BYTES)
                if not self.raw:
                    return False
            data = self.zip.decompress(self.raw, READ_BYTES)
            self.raw = b"" if self.zip.eof else self.zip.unconsumed_tail
            if data:
                self.buffer += data
                return True

    def head(self) -> list[str]:
        """Lines up to an empty one; none at the end of the file."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buffer:
                    raise ValueError("archive ends within a record")
                return []
        lines, self.buffer = self.buffer[:end].decode().split("\r\n"), self.buffer[end + 4 :]
        return lines

    def take(self, most: int) -> bytes:
        """The next `most` bytes, fewer only if the file ends."""
        while len(self.buffer) < most and self.more():
            pass
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data


def _fields(lines: list[str]) -> dict[str, str]:
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines[1:])}


def chunks_of(file, chunk_bytes: int, with_content: bool) -> Iterator[dict]:
    """Chunk rows of an archive, the digest and size so far on each."""
    reader = Reader(file)
    while lines := reader.head():
        warc = _fields(lines)
        start = len("\r\n".join(http := reader.head()).encode()) + 4
        left, size, digest, at = int(warc["content-length"]) - start, 0, hashlib.sha256(), 0
        ids = {name: warc.get(field) for name, field in (("page_id", "page-id"), ("refers_to", "refers-to-page-id"))}
        row = {k: v and int(v) for k, v in ids.items()}
        row |= {"url": warc.get("warc-target-uri"), "record_type": warc["warc-type"]}
        if row["record_type"] == "revisit":
            known = {"payload_bytes": int(_fields(http)["content-length"]), "payload_digest": warc["warc-payload-digest"].split(":")[1]}
            yield row | known | {"chunk_no": 0, "is_last": True, "content": None}
        while row["record_type"] != "revisit":
            data = reader.take(min(left, chunk_bytes))
            digest.update(data)
            size, left = size + len(data), left - len(data)
            if left and not data:
                raise ValueError("archive ends within a payload")
            known = {"payload_bytes": size, "payload_digest": digest.hexdigest()}
            yield row | known | {"chunk_no": at, "is_last": not left, "content": data if with_content else None}
            at += 1
            if not left:
                if f"sha256:{known['payload_digest']}" != warc["warc-payload-digest"]:
                    raise ValueError(f"payload of page {row['page_id']} is damaged")
                break
        if reader.take(4) != b"\r\n\r\n":
            raise ValueError("record is not ended")


def read_warc(spark: SparkSession, manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_content: bool = True) -> DataFrame:
    """Chunk rows of the archives in a manifest; one task reads an archive as a stream.

    `payload_bytes` and `payload_digest` are of the payload so far, and of the whole payload where `is_last`. A
    revisit is one row without content and has size and digest of the full payload.
    """
    ready(spark)
    names = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    names += [("chunk_no", pa.int64()), ("is_last", pa.bool_()), ("content", pa.binary())]
    schema = pa.schema([*names, ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                rows: list[dict] = []
                with system.open_input_stream(at, compression=None) as file:
                    for row in chunks_of(file, chunk_bytes, with_content):
                        rows.append(row)
                        if len(rows) == 64:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, CHUNKS)
