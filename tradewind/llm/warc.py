"""WARC archives as a Spark data source, with payload deduplication by revisit records.

Writing: every task rolls files of about ``roll`` bytes under names of its own; the commit lists the files of
the tasks that won in a manifest, and readers see only those, so retried or lost tasks leave no trace in
the data. Reading: files are the partitions, packed up to ``split`` bytes by the manifest's sizes. Filters
on record type and on other header fields are pushed down: headers are parsed first, and the payload of a
record that fails them, or that ``payload=false`` does not want, is skipped by seeking over its length.

Defined results: rows with a null id are left out; rows with equal ids are records of their own, each judged by its payload;
a null payload is empty; null header values are left out and read back as null; equal
payloads below the least size are all responses; of larger ones the record with the smallest id is the
response; an archive without records reads as no rows; a payload that does not match its digest is an error.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from tradewind.session import scratch_path

SCHEMA = "record_type string, record_id long, target_uri string, refers_to long, payload_digest string, payload_bytes long, payload binary"
MANIFEST = "manifest.json"
LEAST = 100
_URN = "<urn:record:{}>"
_VERSION = b"WARC/1.1\r\n"
#: Column to header name; these fields can be filtered before the payload is read.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it for; a path without one must not end on a machine's disk."""
    if "://" in path or path.startswith("file:"):
        return path
    probe = f"{path}/qualify-{uuid.uuid4().hex}"
    spark.range(1).coalesce(1).write.parquet(probe)
    found = next(f for f in spark.read.parquet(probe).inputFiles())
    return found[: found.index("/qualify-")]


def filesystem(path: str):
    """(filesystem, path) for a shared folder given as a path or URI."""
    from pyarrow import fs

    if path.startswith("file:") and "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def encode(row: dict, compress: bool = True) -> bytes:
    """One record. A response holds an HTTP message, its content encoded by gzip or plain; a revisit holds headers only.

    Record headers stay plain, so that readers can test them and seek over the rest.
    """
    body = bytes(row["payload"] or b"")
    compress = compress and row["record_type"] != "revisit" and len(body) >= LEAST
    content = gzip.compress(body, 3, mtime=0) if compress else body
    coding = b"Content-Encoding: gzip\r\n" if compress else b""
    length = row["payload_bytes"] if row["record_type"] == "revisit" else len(content)
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": _URN.format(row["record_id"]),
        "WARC-Target-URI": row["target_uri"],
        "WARC-Refers-To": None if row["refers_to"] is None else _URN.format(row["refers_to"]),
        "WARC-Payload-Digest": "sha256:" + row["payload_digest"],
        "X-Payload-Length": row["payload_bytes"],
        "Content-Type": "application/http; msgtype=response",
    }
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n" % (coding, length)
    block = http if row["record_type"] == "revisit" else http + content
    clean = {k: str(v).replace("\r", "%0D").replace("\n", "%0A") for k, v in fields.items() if v is not None}
    head = "".join(f"{k}: {v}\r\n" for k, v in clean.items()).encode()
    return _VERSION + head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _value(column: str, text: str | None):
    if text is None:
        return None
    if column in ("record_id", "refers_to"):
        return int(text[len("<urn:record:") : -1])
    if column == "payload_bytes":
        return int(text)
    return text.removeprefix("sha256:") if column == "payload_digest" else text


def records(stream, tests: list[tuple[str, frozenset | None]], payload: bool = True) -> Iterator[tuple]:
    """Rows of SCHEMA. ``tests`` are (column, allowed values, or None for any but null), applied to the headers."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if line != _VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        length = int(fields["Content-Length"])
        row = {c: _value(c, fields.get(h)) for c, h in HEADERS.items()}
        if any(row[c] is None or (allowed is not None and row[c] not in allowed) for c, allowed in tests):
            stream.seek(length, io.SEEK_CUR)
            continue
        body = None
        if payload and row["record_type"] != "revisit":
            http, _, body = stream.read(length).partition(b"\r\n\r\n")
            if b"\r\nContent-Encoding: gzip\r\n" in http:
                body = gzip.decompress(body)
            if hashlib.sha256(body).hexdigest() != row["payload_digest"]:
                raise ValueError(f"record {row['record_id']} does not match its digest")
        else:
            stream.seek(length, io.SEEK_CUR)
        yield (*(row[c] for c in HEADERS), body)


@dataclass
class Files(InputPartition):
    names: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split = int(options.get("split", 64 << 20))
        self.payload = options.get("payload", "true").lower() == "true"
        self.tests: list[tuple[str, frozenset | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((column, frozenset([f.value])))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, frozenset(f.value)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        system, root = filesystem(self.path)
        with system.open_input_stream(f"{root}/{MANIFEST}") as f:
            files = json.loads(f.read())
        out, names, size = [], [], 0
        for name, length in sorted(files, key=lambda x: (-x[1], x[0])):
            if names and size + length > self.split:
                out.append(Files(tuple(names)))
                names, size = [], 0
            names.append(name)
            size += length
        return [*out, Files(tuple(names))] if names or not out else out

    def read(self, partition: Files) -> Iterator[tuple]:
        system, root = filesystem(self.path)
        for name in partition.names:
            with system.open_input_file(f"{root}/{name}") as f:
                yield from records(io.BufferedReader(_Raw(f), 1 << 20), self.tests, self.payload)


class _Raw(io.RawIOBase):
    """An Arrow file as a raw stream, for buffered lines and seeks."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self.file.seek(offset, whence)

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.roll = int(options.get("roll", 32 << 20))
        self.compress = options.get("compress", "true").lower() == "true"

    def write(self, rows: Iterator) -> Written:
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        files, out, name, size = [], None, "", 0
        for row in rows:
            if out is None:
                name, size = f"part-{uuid.uuid4().hex}.warc", 0
                out = system.open_output_stream(f"{root}/{name}")
            data = encode(row.asDict(), self.compress)
            out.write(data)
            size += len(data)
            if size >= self.roll:
                out.close()
                files.append((name, size))
                out = None
        if out is not None:
            out.close()
            files.append((name, size))
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{MANIFEST}.new") as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())
        system.move(f"{root}/{MANIFEST}.new", f"{root}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = filesystem(self.path)
        for message in messages:
            for name, _ in message.files if message else ():
                system.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make format("warc") known and let filters reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """The records to write. Only ids and digests are shuffled to find the first page of each digest."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("record_id"), F.col(url_col).alias("target_uri"), F.sha2(payload, 256).alias("payload_digest"),
        F.length(payload).cast("long").alias("payload_bytes"), payload.alias("payload"),
    )
    first = rows.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("digest")).agg(F.min("record_id").alias("first_id"))
    keys = rows.where(F.col("payload_bytes") >= least).select("record_id", "payload_digest")
    again = keys.join(first, F.col("payload_digest") == F.col("digest")).where("record_id > first_id")
    again = again.select(F.col("record_id").alias("again_id"), F.col("digest").alias("again_digest"), "first_id").distinct()
    placed = rows.join(again, (F.col("record_id") == F.col("again_id")) & (F.col("payload_digest") == F.col("again_digest")), "left")
    revisit = F.col("first_id").isNotNull()
    return placed.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), "record_id", "target_uri", F.col("first_id").alias("refers_to"),
        "payload_digest", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def archived(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder and read it back."""
    path = qualified(pages.sparkSession, scratch_path(pages.sparkSession, "warc"))
    write(deduplicated(pages, **columns), path)
    return read(pages.sparkSession, path)
