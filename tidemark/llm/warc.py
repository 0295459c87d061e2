"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Every record is a gzip member of its own whose header tells its packed length. A reader unpacks
the record's head first, tests it against the pushed predicates, and skips the rest of records
that nobody wants. Writers leave a file per task; a commit lists the files that count, so what
broken tasks leave is never read. Files are reached through Arrow's file systems by their URI.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In,
                                    InputPartition, IsNotNull, WriterCommitMessage)

from tidemark.session import scratch

#: Fixed values of the contract: payloads from this size on are stored once.
REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("record_type string, page_id long, target_uri string, refers_to long, payload_digest string,"
          " payload_bytes long, payload binary")
#: Columns whose predicates are tested on a record's head.
HEAD_COLUMNS = ("record_type", "page_id", "target_uri", "refers_to", "payload_digest")
PART_BYTES, BATCH_BYTES, HEAD_BYTES = 64 << 20, 4 << 20, 1 << 12


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; Hadoop's names of S3 are Arrow's ``s3``, and what Arrow can't open is an error."""
    path = re.sub("^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member whose extra field "sl" holds packed and full length."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = packer.compress(data) + packer.flush()
    extra = b"sl" + struct.pack("<HII", 8, len(packed), len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(kind: str, page: int | None, uri: str | None, refers_to: int | None, digest: str, size: int, payload: bytes) -> bytes:
    """A response or revisit record; only a response has the payload."""
    def name(of: int | None) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{of}')}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    packed = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", name(page)), ("WARC-Date", DATE), ("WARC-Target-URI", uri and uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", f"sha1:{packed}"), ("X-Page-ID", page)]
    if kind == "revisit":
        head += [("WARC-Refers-To", name(refers_to)), ("X-Refers-To-Page", refers_to), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass
class Part(InputPartition):
    files: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


class Warc(DataSource):
    """Options: ``path``, and ``payload`` ("false" leaves payloads null and packed)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self.options)


class Writer(DataSourceArrowWriter):
    """Takes the columns of SCHEMA; a revisit's payload is not stored."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, top = place(self.path)
        files.create_dir(top, recursive=True)
        name, out = f"part-{uuid.uuid4()}.warc.gz", None
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("record_type", "page_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload"))):
                out = out or files.open_output_stream(f"{top}/{name}", compression=None)
                out.write(member(record(*r)))
        if out:
            out.close()
        return Written((name,) if out else ())

    def commit(self, messages: list[Written]) -> None:
        files, top = place(self.path)
        files.create_dir(top, recursive=True)
        with files.open_output_stream(f"{top}/_committed-{uuid.uuid4()}.json") as out:
            out.write(json.dumps([n for m in messages if m for n in m.files]).encode())

    def abort(self, messages: list[Written]) -> None:
        """Files without a commit are not read."""


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload, self.tests = options["path"], options.get("payload", "true") != "false", []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality, membership and presence on columns of the head; the rest stays with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 else None
            if column not in HEAD_COLUMNS:
                yield f
            else:
                self.tests.append((column, None if isinstance(f, IsNotNull) else [f.value] if isinstance(f, EqualTo) else list(f.value)))

    def partitions(self) -> list[Part]:
        files, top = place(self.path)
        found = {i.path.rpartition("/")[2]: i for i in files.get_file_info(fs.FileSelector(top))}
        listed = set()
        for name, info in found.items():
            if name.startswith("_committed-"):
                with files.open_input_stream(info.path) as source:
                    listed |= set(json.loads(source.read()))
        parts, size = [[]], 0
        for name in sorted(listed):
            if size and size + found[name].size > PART_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(found[name].path)
            size += found[name].size
        return [Part(tuple(p)) for p in parts if p] or [Part(())]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        kinds = {"record_type": pa.string(), "page_id": pa.int64(), "target_uri": pa.string(), "refers_to": pa.int64(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        files, _ = place(self.path)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], names=list(kinds))

        for name in partition.files:
            with files.open_input_file(name) as source:
                for row in records(source, self.tests, self.payload):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= BATCH_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


def wanted(row: dict, tests: list[tuple]) -> bool:
    return all(row[c] is not None and (values is None or row[c] in values) for c, values in tests)


def parse(head: bytes) -> dict:
    """Columns of a record's head and, as ``skip``, the length of both of its headers."""
    warc, _, rest = head.partition(b"\r\n\r\n")
    http, _, _ = rest.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in warc.decode().split("\r\n")[1:])
    inner = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    number = lambda v: None if v is None else int(v)
    uri = fields.get("WARC-Target-URI")
    return {"record_type": fields["WARC-Type"], "page_id": number(fields.get("X-Page-ID")),
            "target_uri": uri and uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "refers_to": number(fields.get("X-Refers-To-Page")), "payload_bytes": number(inner.get("Content-Length")),
            "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
            "payload": None, "skip": len(warc) + len(http) + 8}


def records(source, tests: list[tuple], payload: bool) -> Iterator[dict]:
    """Records whose heads pass the tests; of others, and without ``payload``, only the head is unpacked."""
    end, at = source.size(), 0
    while at < end:
        source.seek(at)
        start = source.read(12)
        extra = source.read(struct.unpack("<H", start[10:])[0])
        size = struct.unpack("<I", extra[4:8])[0]
        body, at = at + 12 + len(extra), at + 12 + len(extra) + size + 8
        packed, unpacker = source.read(min(size, HEAD_BYTES)), zlib.decompressobj(-15)
        head = unpacker.decompress(packed, HEAD_BYTES)
        while head.count(b"\r\n\r\n") < 2 and not unpacker.eof:
            more = unpacker.unconsumed_tail or source.read(min(HEAD_BYTES, body + size - source.tell()))
            head += unpacker.decompress(more, HEAD_BYTES)
        row = parse(head)
        skip = row.pop("skip")
        if not wanted(row, tests):
            continue
        if payload and row["record_type"] == "response":
            rest = unpacker.unconsumed_tail + source.read(body + size - source.tell())
            whole = head + unpacker.decompress(rest) + unpacker.flush()
            row["payload"] = whole[skip:skip + row["payload_bytes"]]
        yield row


def archive(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Records of SCHEMA for pages: of equal payloads of some size that with the largest key is the response.

    Null pages are empty payloads, and empty ones are responses. A very long page is one record, packed and
    unpacked whole. Columns other than the three named are not read, so their names can't clash. Rows that repeat the largest key are all responses; a null key
    is smaller than any other, and payloads that have only null keys are all responses.
    """
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.length("payload").cast("long"))
    large = F.col("payload_bytes") >= REVISIT_BYTES
    firsts = rows.where(large).groupBy(F.col("payload_digest").alias("its_digest"), F.col("payload_bytes").alias("its_bytes")).agg(
        F.max("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1 AND first IS NOT NULL")
    joined = rows.join(firsts, (F.col("payload_digest") == F.col("its_digest")) & (F.col("payload_bytes") == F.col("its_bytes")), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(F.when(again, "revisit").otherwise("response").alias("record_type"), "page_id", "target_uri",
                         F.when(again, F.col("first")).alias("refers_to"), "payload_digest", "payload_bytes", "payload")


def write_archives(records_: DataFrame, path: str) -> None:
    place(path)  # before any task runs
    records_.sparkSession.dataSource.register(Warc)
    records_.write.format("warc").mode("append").option("path", path).save()


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives below ``path``. Turns on the session's push-down into Python sources."""
    spark.dataSource.register(Warc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Archive pages in the shared folder and read them back; digests of responses are taken from what was read.

    The type of a record is a pushed predicate: responses are unpacked for their payloads, and of revisits
    only heads are read, which tell the digest of what they refer to.
    """
    spark, path = pages.sparkSession, scratch(pages.sparkSession)
    write_archives(archive(pages, **columns), path)
    responses = read_archives(spark, path).where(F.col("record_type") == "response").withColumn("payload_digest", F.sha1("payload"))
    return responses.unionByName(read_archives(spark, path, payload=False).where(F.col("record_type") == "revisit"))
