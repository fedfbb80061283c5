"""WARC archives as a PySpark Python data source, and pages archived with revisit records.

Reading plans a partition for each archive file. Filters on the record type and on the other header
columns are pushed into the scan: a record's headers are parsed first, and the block of one that no
filter wants is skipped by its length, unread and undecoded. Payloads are stored gzip-encoded in
their HTTP message, so the archive itself can be walked by offsets.

Writing gives each task a file of its own, named by task and attempt; the commit lists the files of the
attempts that won in a manifest, and readers see only those. A repeated task leaves nothing visible.
Archives that others wrote have no manifest: with option("manifest", "false") every .warc and .warc.gz file of
the folder is read. Columns whose headers they lack are null, and a body that is no gzip stream in spite
of its header is returned as stored.

Records with equal payloads of at least 100 bytes: the one with the smallest page id is the response,
the others revisit it. Smaller payloads are all responses.

Defined results: a null page counts as empty. Control characters in a URL are percent-encoded in the
archive. Pages without id are responses. Repeated rows of the smallest id are responses each.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidewheel.llm.common import work_path

SCHEMA = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)
REVISIT_BYTES = 100
MANIFEST = "manifest.json"
ENDINGS = (".warc", ".warc.gz")
#: Fixed: header names of the archive format, ours with a prefix.
_HEADERS = {
    "page_id": "X-Page-Id", "url": "WARC-Target-URI", "record_type": "WARC-Type", "payload_bytes": "X-Payload-Bytes",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "X-Refers-To",
}
_NUMBERS = {"page_id", "payload_bytes", "refers_to"}


def open_folder(path: str):
    """File system and plain path of a folder named by a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "", 1))


def _record(row: dict) -> bytes:
    """One record: headers, then for a response an HTTP message with the gzip-encoded payload."""
    block = b""
    if row["record_type"] == "response":
        body = gzip.compress(row["payload"] or b"", 6, mtime=0)
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: gzip\r\nContent-Length: {len(body)}\r\n\r\n"
        block = http.encode() + body
    lines = ["WARC/1.1", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr((row['page_id'], row['url'])))}>"]
    for column, header in _HEADERS.items():
        value = row[column]
        if value is None:
            continue
        if column == "url":
            value = "".join(quote(c) if ord(c) < 33 or ord(c) == 127 else c for c in value)
        elif column == "payload_digest":
            value = f"sha256:{value}"
        lines.append(f"{header}: {value}")
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def read_records(file, wants=lambda headers: True, strict: bool = True) -> Iterator[dict]:
    """Records whose headers are wanted; blocks of the others are passed over by their length.

    A body that cannot be unpacked is an error, or comes as stored where not strict.
    """
    while True:
        line = file.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should start: {line[:40]!r}")
        named = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            named[name.strip().lower()] = value.strip()
        length = int(named["content-length"])
        headers: dict = {}
        for column, header in _HEADERS.items():
            value = named.get(header.lower())
            if value is not None and column in _NUMBERS:
                value = int(value)
            headers[column] = value.removeprefix("sha256:") if column == "payload_digest" and value else value
        if not wants(headers):
            file.seek(length + 4, io.SEEK_CUR)
            continue
        block = file.read(length)
        file.seek(4, io.SEEK_CUR)
        payload = None
        if headers["record_type"] == "response":
            head, _, body = block.partition(b"\r\n\r\n")
            try:
                payload = gzip.decompress(body) if b"content-encoding: gzip" in head.lower() else body
            except (OSError, EOFError, zlib.error):
                if strict:
                    raise
                payload = body
        yield headers | {"payload": payload}


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    records: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc"
        records = 0
        with files.open_output_stream(posixpath.join(folder, name)) as out:
            for batch in iterator:
                for at in range(0, len(batch), 256):
                    rows = batch.slice(at, 256).to_pylist()
                    out.write(b"".join(map(_record, rows)))
                    records += len(rows)
        return Written(name, records)

    def commit(self, messages: list) -> None:
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        names = sorted(m.file for m in messages if m is not None and m.records)
        with files.open_output_stream(posixpath.join(folder, MANIFEST)) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        files, folder = open_folder(self.path)
        for m in messages:
            if m is not None and m.file:
                files.delete_file(posixpath.join(folder, m.file))


class WarcReader(DataSourceReader):
    def __init__(self, path: str, manifest: bool = True):
        self.path, self.manifest = path, manifest
        self.equal: list[tuple[str, tuple]] = []
        self.null: list[tuple[str, bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in _HEADERS and isinstance(f, EqualTo):
                self.equal.append((column, (f.value,)))
            elif column in _HEADERS and isinstance(f, In):
                self.equal.append((column, tuple(f.value)))
            elif column in _HEADERS and isinstance(f, (IsNull, IsNotNull)):
                self.null.append((column, isinstance(f, IsNull)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        files, folder = open_folder(self.path)
        if self.manifest:
            with files.open_input_stream(posixpath.join(folder, MANIFEST)) as manifest:
                names = json.loads(manifest.read())
        else:
            from pyarrow.fs import FileSelector

            names = sorted(f.base_name for f in files.get_file_info(FileSelector(folder)) if f.base_name.endswith(ENDINGS))
        return [InputPartition(posixpath.join(folder, n)) for n in names] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        equal, null = self.equal, self.null

        def wants(headers: dict) -> bool:
            return all(headers[c] in v for c, v in equal) and all((headers[c] is None) == n for c, n in null)

        kinds = {"payload": pa.binary()} | {c: pa.int64() if c in _NUMBERS else pa.string() for c in _HEADERS}
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        files, _ = open_folder(self.path)

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in names], names=names)

        packed = partition.value.endswith(".gz")
        with files.open_input_file(partition.value) as raw, io.BufferedReader(raw, 1 << 18) as plain:
            file = gzip.GzipFile(fileobj=plain) if packed else plain
            held, size = [], 0
            for record in read_records(file, wants, self.manifest):
                held.append(record)
                size += len(record["payload"] or b"")
                if len(held) >= 1024 or size > 1 << 22:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder); df.write.format("warc").mode("append").save(folder)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("manifest", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed into Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def revisit_plan(pages: DataFrame) -> DataFrame:
    """Rows of pages (page_id, url, html) as records with their type; see above for the rule."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).select(
        "page_id", "url", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "payload",
    )
    firsts = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).where("n > 1").select("payload_digest", "first")
    again = F.col("first").isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first"))
    return rows.join(firsts, "payload_digest", "left").select(
        "page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"),
        "payload_bytes", "payload_digest", F.when(again, F.col("first")).alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_archive(pages: DataFrame, folder: str | None = None) -> str:
    """Write pages to archives in folder (a fresh one of the shared folder if none); returns the folder."""
    spark = pages.sparkSession
    register(spark)
    folder = folder or work_path(spark, "warc")
    revisit_plan(pages).write.format("warc").mode("append").save(folder)
    return folder


def read_archive(spark: SparkSession, folder: str, manifest: bool = True) -> DataFrame:
    """Records of archives. Spark keeps one set of pushed filters a relation: read anew for each filter."""
    register(spark)
    return spark.read.format("warc").option("manifest", str(manifest).lower()).load(folder)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages to archives in folder and read them back."""
    return read_archive(pages.sparkSession, write_archive(pages, folder))
