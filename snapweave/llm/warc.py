"""Operator 5, WARC archives through a PySpark Python data source ("warc").

Reading plans one partition for each archive file, accepts equality and IN predicates on the record type and
on header columns, and within a file parses a record's headers first. A record that the predicates reject, or
whose payload isn't asked for (option payload=false), is stepped over: in plain files by its length, in
files written here by the compressed length that each gzip member carries in its extra field ("sl"), in
other gzip files by inflating without keeping.

Writing makes files of about `file_bytes`, one gzip member for each record, under names that are random for
each task attempt. Only a commit puts their names into the manifest, so files of lost or repeated attempts
are never read.

`archive` marks as revisits the pages whose payload another page with a smaller page_id has too. Defined
results: null html is the empty payload; rows that repeat both page_id and payload are all responses; a null
page_id comes after all others and is written without record id; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "file string, offset long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, content_type string, payload_bytes long, payload binary"
ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), *((c, pa.string()) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "content_type")), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
#: Columns that predicates may use, and the header each is read from.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
FILE_BYTES = 64 << 20
_EXTRA = struct.Struct("<2sHII")  # "sl", 8, compressed and plain length of the member


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes) -> bytes:
    """A gzip member whose extra field tells its own length."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    length = 12 + _EXTRA.size + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", _EXTRA.size) + _EXTRA.pack(b"sl", 8, length & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(kind: str, record_id: str | None, uri: str | None, refers_to: str | None, payload: bytes) -> bytes:
    """A response record, or a revisit with the HTTP header only, of an HTML payload."""
    safe = lambda s: re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", s)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    head += [f"{name}: {safe(value)}" for name, value in (("WARC-Record-ID", record_id), ("WARC-Target-URI", uri), ("WARC-Refers-To", refers_to)) if value is not None]
    head += [f"WARC-Profile: {REVISIT_PROFILE}"] if kind == "revisit" else []
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class _Inflater:
    """Bytes of a gzip member on demand."""

    def __init__(self, stream, limit: int | None):
        self.stream, self.left, self.z, self.held = stream, limit, zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.z.eof:
            return False
        raw = self.z.unconsumed_tail or self.stream.read(1 << 16 if self.left is None else min(1 << 16, self.left))
        if not raw:
            return False
        if self.left is not None and not self.z.unconsumed_tail:
            self.left -= len(raw)
        self.held += self.z.decompress(raw, 1 << 16)
        return True

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.held:
            if not self.more():
                return None
        head, self.held = self.held.split(mark, 1)
        return head

    def take(self, n: int) -> bytes:
        parts, got = [self.held], len(self.held)
        self.held = b""
        while got < n and self.more():
            parts.append(self.held)
            got, self.held = got + len(self.held), b""
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]


class _Plain:
    def __init__(self, stream):
        self.stream = stream

    def until(self, mark: bytes) -> bytes | None:
        held = b""
        while mark not in held:
            more = self.stream.read(1024)
            if not more:
                return None
            held += more
        head, rest = held.split(mark, 1)
        self.stream.seek(self.stream.tell() - len(rest))
        return head

    def take(self, n: int) -> bytes:
        return self.stream.read(n)


def _payload(headers: dict[str, str], source, length: int, wanted: bool) -> tuple[int | None, bytes | None, int]:
    """(payload length, payload if wanted, bytes of the block that were taken)."""
    if not headers.get("content-type", "").startswith("application/http"):
        return length, (source.take(length) if wanted else None), length if wanted else 0
    http = source.until(b"\r\n\r\n")
    if http is None:
        return None, None, length
    told = parse_headers(http).get("content-length", "")
    rest = length - len(http) - 4
    full = int(told) if told.isdigit() else rest
    if headers.get("warc-type") == "revisit" or not wanted:
        return full, None, len(http) + 4
    return full, source.take(rest), length


def records(stream, compressed: bool, accept, payload: bool) -> Iterator[tuple[int, dict[str, str], int | None, bytes | None]]:
    """(offset, headers, payload length, payload) of the records that accept(headers) takes."""
    while True:
        offset = stream.tell()
        if not compressed:
            plain = _Plain(stream)
            raw = plain.until(b"\r\n\r\n")
            if raw is None:
                return
            headers = parse_headers(raw.lstrip(b"\r\n"))
            start, length = stream.tell(), int(headers.get("content-length", 0))
            if accept(headers):
                yield (offset, headers, *_payload(headers, plain, length, payload)[:2])
            stream.seek(start + length + 4)
            continue
        head = stream.read(12 + _EXTRA.size)
        if len(head) < 18:
            return
        known = None
        if head[3] & 4 and head[12:14] == b"sl" and len(head) == 12 + _EXTRA.size:
            known = _EXTRA.unpack(head[12:])[2]
        stream.seek(offset)
        inflater = _Inflater(stream, known)
        raw = inflater.until(b"\r\n\r\n")
        if raw is None:
            return
        headers = parse_headers(raw)
        length = int(headers.get("content-length", 0))
        if accept(headers):
            yield (offset, headers, *_payload(headers, inflater, length, payload)[:2])
        if known:
            stream.seek(offset + known)
            continue
        while True:  # a foreign member's end is only known from inflating it
            inflater.held = b""
            if not inflater.more():
                break
        stream.seek(stream.tell() - len(inflater.z.unused_data))


@dataclass
class ArchiveFile(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):
        """Keep equality and IN on header columns for `read`; hand the others back to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADERS:
                self.wanted.append((name, frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        scheme = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else ""
        if fs.get_file_info(root).is_file:
            return [ArchiveFile(self.path)]
        manifests = [f for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.startswith(MANIFEST)]
        if manifests:
            names = []
            for m in manifests:
                with fs.open_input_stream(m.path) as stream:
                    names += json.loads(stream.read())
        else:
            names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(root)) if f.base_name.endswith((".warc", ".warc.gz"))]
        return [ArchiveFile(f"{scheme}{root}/{name}") for name in sorted(names)]

    def read(self, partition: ArchiveFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's stand-in for no partitions
            return

        def accept(headers: dict[str, str]) -> bool:
            return all(column(headers, name) in values for name, values in self.wanted)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(held, schema=ARROW)

        fs, path = pafs.FileSystem.from_uri(partition.uri)
        held, size = [], 0
        with fs.open_input_file(path) as stream:
            for offset, headers, length, payload in records(stream, path.endswith(".gz"), accept, self.payload):
                held.append({"file": partition.uri, "offset": offset, "payload_bytes": length, "payload": payload, **{c: column(headers, c) for c in HEADERS}})
                size += len(payload or b"") + 500
                if size > 4 << 20:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()


def column(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADERS[name])
    if value is not None and name in ("record_id", "refers_to"):
        return value.strip("<>")
    if value is not None and name == "payload_digest":
        return value.rpartition(":")[2]
    return value


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceWriter):
    """Rows: record_type, record_id, target_uri, refers_to, payload."""

    def __init__(self, options: dict):
        self.path, self.file_bytes = options["path"], int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for row in iterator:
                if out is None:
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                raw = member(record_bytes(row["record_type"], row["record_id"], row["target_uri"], row["refers_to"], bytes(row["payload"] or b"")))
                out.write(raw)
                size += len(raw)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for name in (n for m in messages if m for n in m.names):
            if fs.get_file_info(f"{root}/{name}").is_file:
                fs.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def to_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """record_type, record_id, target_uri, refers_to and payload of each page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    joined = rows.join(first, "digest")
    response = F.col("page_id").eqNullSafe(F.col("first_id")) | (F.octet_length("payload") < min_bytes)
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return joined.select(F.when(response, "response").otherwise("revisit").alias("record_type"), urn(F.col("page_id")).alias("record_id"), "target_uri", F.when(~response, urn(F.col("first_id"))).alias("refers_to"), "payload")


def archive(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write a record for each page under path."""
    register(pages.sparkSession)
    to_records(pages, min_bytes).write.format("warc").mode("append").option("file_bytes", file_bytes).save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row for each archived page: lengths and digests from decoded payloads, for revisits from headers."""
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    responses = read(spark, path).where(F.col("record_type") == "response").select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.unhex(F.sha1("payload"))).alias("payload_digest"), "record_type", "refers_to")
    revisits = read(spark, path, payload=False).where(F.col("record_type") == "revisit").select("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    rows = responses.unionByName(revisits)
    return rows.select(page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to"))


def base32(digest):
    """Base32 of 20 bytes, as an expression: each 5 bytes are 40 bits, read as 8 letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = [F.conv(F.hex(F.substring(digest, 1 + 5 * g, 5)), 16, 10).cast("long") for g in range(4)]
    letters = [F.substring(alphabet, (F.shiftright(n, 5 * k).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for n in groups for k in range(7, -1, -1)]
    return F.concat(*letters)
