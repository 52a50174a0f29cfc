"""WARC archives as a PySpark data source, written and read through pyarrow file systems.

Reading: each partition is a run of archive files of a planned size. Filters on the record type and
on headers are pushed to the reader, which parses a record's headers first and passes over
its payload unless the record passes and the schema asks for the payload. Records are
gzip members; the writer notes a member's size in its gzip header, so an unwanted member is
sought over unread. Members without the note and plain .warc files are read too.

Writing: a task writes its records to files of bounded size under names of its own; the commit
lists the files of the tasks that succeeded in a manifest, so files of lost tasks are never read.

Defined results: a null payload column is an empty payload, rows that share the
largest page_id of equal payloads are all responses; a null page_id is never referred to by others
while its group has another; other columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage,
)

from tabsmith.session import work_path

MANIFEST = "_warc_manifest.json"
FILE_BYTES, PARTITION_BYTES, BATCH_BYTES = 64 << 20, 32 << 20, 8 << 20
#: Headers of the WARC format, and the one of this writer that holds a revisit's full size.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_length": "X-Payload-Length",
}
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_length long, payload binary")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MEMBER = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x0c\x00SL\x08\x00"  # a gzip header with an extra field of 8 bytes


def _files(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith(("file:", "/")):
        return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))
    raise ValueError(f"{path}: name the folder by a URI or an absolute path")


def member(data: bytes, level: int) -> bytes:
    """A gzip member that notes its own size."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(data) + packer.flush()
    size = len(_MEMBER) + 8 + len(body) + 8
    return _MEMBER + struct.pack("<Q", size) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """One record of a row: record_id, record_type, target_uri, date, refers_to, payload_digest, payload_length, payload."""
    payload = row["payload"] or b""
    if row["record_type"] not in ("response", "revisit"):
        raise ValueError(f"records of type {row['record_type']} are not written")
    block = _HTTP + payload if row["record_type"] == "response" else _HTTP
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        if row.get(column) is not None:
            lines.append(f"{name}: " + str(row[column]).replace("\r", "%0D").replace("\n", "%0A"))
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.level = options["path"].rstrip("/"), int(options.get("level", "1"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _files(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        files.append([f"part-{uuid.uuid4().hex}.warc.gz", 0])
                        out, size = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                    data = member(record(row), self.level)
                    out.write(data)
                    size += len(data)
                    files[-1][1] = size
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages) -> None:
        store, root = _files(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        store, root = _files(self.path)
        for name, _ in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{root}/{name}")


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(None)
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.path = options["path"].rstrip("/")
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.schema = schema
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column not in HEADERS or column == "payload_length":
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((HEADERS[column], "in", {f.value}))
            elif isinstance(f, In):
                self.tests.append((HEADERS[column], "in", set(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((HEADERS[column], "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((HEADERS[column], "there", None))
            else:
                yield f

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            found = headers.get(name.lower())
            if found is None or kind == "in" and found not in value or kind == "starts" and not found.startswith(value):
                return False
        return True

    def partitions(self):
        from pyarrow import fs

        store, root = _files(self.path)
        manifest = store.get_file_info(f"{root}/{MANIFEST}")
        if manifest.type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}", compression=None) as f:
                files = [(name, size) for name, size in json.loads(f.read())]
        else:
            infos = store.get_file_info(fs.FileSelector(root, recursive=True))
            files = [(i.path[len(root) + 1:], i.size) for i in infos if i.type == fs.FileType.File and i.path.endswith((".warc", ".warc.gz"))]
        parts, size = [], 0
        for name, n in sorted(files):
            if not parts or size + n > self.partition_bytes:
                parts.append(_Files([]))
                size = 0
            parts[-1].files.append(name)
            size += n
        return parts or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, root = _files(self.path)
        arrow = to_arrow_schema(self.schema)
        rows, size = [], 0
        for name in partition.files:
            with store.open_input_file(f"{root}/{name}") as f:
                for headers, payload in records(f, name.endswith(".gz"), self._wanted, "payload" in arrow.names or self.verify):
                    row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    row["payload"] = payload if row["record_type"] == "response" else None
                    if self.verify and row["record_type"] == "response" and row["payload_digest"] != digest(payload):
                        raise ValueError(f"{name}: {row['record_id']} has another digest than its header says")
                    row["payload_length"] = int(row["payload_length"]) if row["payload_length"] is not None else None
                    rows.append(row)
                    size += 500 + len(payload or b"") * ("payload" in arrow.names)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
        if rows or not partition.files:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


def digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_headers(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the version line has none."""
    pairs = (line.partition(":") for line in head.decode(errors="replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """A response's payload: what follows the headers of the HTTP message."""
    if "application/http" in headers.get("content-type", ""):
        return block.partition(b"\r\n\r\n")[2]
    return block


def records(f, gzipped: bool, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the wanted records of an open file; without `payloads`, None instead of them."""
    return _gzip_records(f, wanted, payloads) if gzipped else _plain_records(f, wanted, payloads)


def _plain_records(f, wanted, payloads):
    size, at, kept = f.size(), 0, b""
    while at < size or kept:
        while b"\r\n\r\n" not in kept.lstrip(b"\r\n") and at < size:
            f.seek(at)
            data = f.read(4096)
            at += len(data)
            kept += data
        kept = kept.lstrip(b"\r\n")
        head, end, rest = kept.partition(b"\r\n\r\n")
        if not end:
            return
        headers = parse_headers(head)
        length = int(headers.get("content-length", 0))
        if wanted(headers) and payloads:
            if len(rest) < length:
                f.seek(at)
                rest += f.read(length - len(rest))
                at = f.tell()
            yield headers, payload_of(headers, rest[:length])
            kept = rest[length:]
        else:
            if wanted(headers):
                yield headers, None
            at += max(0, length - len(rest))  # the rest of the block is passed over
            kept = rest[length:]


def _gzip_records(f, wanted, payloads):
    size, at = f.size(), 0
    while at < size:
        f.seek(at)
        start = f.read(len(_MEMBER) + 8)
        if start[:len(_MEMBER)] == _MEMBER:
            end = at + struct.unpack("<Q", start[len(_MEMBER):])[0]
        else:
            end = None
        f.seek(at)
        unpack, data = zlib.decompressobj(zlib.MAX_WBITS | 16), b""
        read = 0

        def more(most: int = 0) -> bytes:
            """The next unpacked bytes, at most so many unless 0."""
            nonlocal read
            source = unpack.unconsumed_tail
            if not source and not unpack.eof:
                source = f.read(min(65536, end - at - read) if end else 65536)
                read += len(source)
                if not source:
                    raise ValueError("an archive ends within a record")
            return unpack.decompress(source, most)

        while b"\r\n\r\n" not in data and not unpack.eof:
            data += more(4096)
        head, _, rest = data.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        take = wanted(headers)
        if take and payloads:
            parts = [rest]
            while not unpack.eof:
                parts.append(more())
            yield headers, payload_of(headers, b"".join(parts)[:int(headers.get("content-length", 0))])
        elif take:
            yield headers, None
        if end is None:  # the member's end is where its unpacking ends
            while not unpack.eof:
                more(1 << 20)
            end = at + read - len(unpack.unused_data)
        at = end


class WarcSource(DataSource):
    """spark.read.format("warc").load(path), df.write.format("warc").save(path)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are written to a new folder; mode must be append")
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # else Spark takes no filters from Python sources
    spark.dataSource.register(WarcSource)


def to_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Rows for the writer of page_id, url, html: equal payloads of `min_bytes` or more are written once.

    Of equal payloads (SHA-1 and size), that of the largest page_id is a response, the others revisit it.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    narrow = pages.select("page_id", payload.alias("payload")).select(
        "page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    groups = narrow.filter(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    # pages that revisit another, without their payloads; the payloads are dealt by page, not by content
    revisits = narrow.join(groups, ["sha1", "size"]).filter("not (page_id <=> first)").select(
        F.coalesce("page_id", F.lit(0)).alias("__page"), F.col("page_id").isNull().alias("__nopage"),
        F.col("sha1").alias("__sha1"), F.col("first").alias("__first")).distinct()
    base = pages.select(
        "page_id", "url", payload.alias("payload"), F.coalesce("page_id", F.lit(0)).alias("__page"), F.col("page_id").isNull().alias("__nopage"))
    base = base.withColumn("__sha1", F.sha1("payload"))
    joined = base.join(revisits.hint("shuffle_hash"), ["__page", "__nopage", "__sha1"], "left")
    revisit = F.col("__first").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(
        name(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").cast("string").alias("target_uri"), F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(revisit, name(F.col("__first"))).alias("refers_to"), F.concat(F.lit("sha1:"), base32("__sha1")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"), F.when(~revisit, F.col("payload")).alias("payload"))


def base32(hex_column: str):
    """Base32 of a hexadecimal column of 40 digits: each 5 digits are 4 letters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for i in range(0, 40, 5):
        number = F.conv(F.substring(hex_column, i + 1, 5), 16, 10).cast("int")
        parts += [alphabet.substr(F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


def write_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> str:
    """Write the pages' records below `path` (else the shared folder) and return the path."""
    spark = pages.sparkSession
    register(spark)
    path = path or work_path(spark, "warc")
    to_records(pages, min_bytes).write.format("warc").mode("append").option("path", path).save()
    return path


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA, verify: bool = False) -> DataFrame:
    """The records below `path`; payloads are unpacked only if `columns` or `verify` ask for them."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("path", path).option("verify", str(verify)).load()
