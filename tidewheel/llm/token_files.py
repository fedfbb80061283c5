"""Token-id files: concatenated ids with Elias-Fano coded document boundaries, as a PySpark data source.

A file holds the ids of its documents end to end, in 16 bits where the vocabulary allows, then the
document boundaries and the document ids as Elias-Fano sequences and a footer. A sequence of n
values below u takes about n * (2 + log2(u / n)) bits: the low bits of each value packed, the high
bits as a bitmap in which value i sets bit (value >> low) + i. Every 256th set bit's place is kept
in 32 bits; select(i) starts there, so an offset is found by reading some dozens of bytes and no
table of 64-bit offsets exists in the file or in memory.

Documents are dealt by ranges of (doc_id, digest of the text, row), so files in the order of their
tasks are in ascending doc_id order, null ids first, and rows of one id are split where they are
many. Each task writes a file of its own; the commit lists the files of the attempts that won, with
their numbers of documents and ids, in a manifest of one line a file. Readers see only those files,
and a repeated task leaves nothing visible. Reading splits a file at equal numbers of ids, found by
search in the boundaries; bounds on doc_id are pushed into the scan and searched for likewise.

Defined results: a null text counts as empty and has the end id alone. Repeated rows and null ids
are documents each; rows of one id are ordered by a digest of their texts. An empty table gives a
folder without files, which reads as no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
    InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidewheel.llm.common import text_bytes, work_path
from tidewheel.llm.token_counts import Encoder, decoded
from tidewheel.llm.warc import open_folder

SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
MANIFEST = "manifest.json"
MAGIC = b"TWTOKID1"
#: Set bits between two kept places.
SAMPLE = 256
#: Bytes of ids that a reading task takes, and that one batch holds, at least one document each.
SPLIT_BYTES, BATCH_BYTES = 64 << 20, 4 << 20
_CHUNK = 1 << 16


class Sequence:
    """A non-decreasing sequence of n values, read from a file by parts."""

    def __init__(self, file, at: int, shape: dict):
        self.file, self.n, self.low = file, shape["n"], shape["low"]
        self.low_at = at
        self.high_at = at + shape["low_bytes"]
        self.high_bytes = shape["high_bytes"]
        self.samples = np.frombuffer(_read(file, self.high_at + self.high_bytes, shape["sample_bytes"]), np.uint32)

    @staticmethod
    def encode(values: np.ndarray) -> tuple[dict, list[bytes]]:
        """The shape of a sequence and its three parts: low bits, high bits, kept places."""
        n = len(values)
        values = values.astype(np.uint64)
        most = int(values[-1]) if n else 0
        low = max(0, (most // n).bit_length() - 1) if n else 0
        packed = []
        for at in range(0, n if low else 0, _CHUNK):
            part = values[at : at + _CHUNK]
            bits = (part[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
            packed.append(np.packbits(bits.astype(np.uint8), bitorder="little").tobytes())
        places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        if n and int(places[-1]) >= 1 << 32:
            raise ValueError("too many documents for one file: write more partitions")
        bitmap = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        bitmap[places] = 1
        parts = [b"".join(packed), np.packbits(bitmap, bitorder="little").tobytes(), places[::SAMPLE].astype(np.uint32).tobytes()]
        return {"n": n, "low": low} | dict(zip(("low_bytes", "high_bytes", "sample_bytes"), map(len, parts))), parts

    def select(self, first: int, last: int) -> np.ndarray:
        """Values first to last - 1."""
        if first >= last:
            return np.zeros(0, np.int64)
        group = first // SAMPLE
        begin = int(self.samples[group])
        following = (last - 1) // SAMPLE + 1
        stop = int(self.samples[following]) if following < len(self.samples) else 8 * self.high_bytes
        raw = _read(self.file, self.high_at + begin // 8, (stop + 7) // 8 - begin // 8)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")) + begin // 8 * 8
        ones = ones[ones >= begin][first - group * SAMPLE : last - group * SAMPLE]
        return ((ones - np.arange(first, last)) << self.low) + self._low_bits(first, last)

    def _low_bits(self, first: int, last: int) -> np.ndarray:
        if not self.low:
            return np.zeros(last - first, np.int64)
        begin, stop = first * self.low, last * self.low
        raw = _read(self.file, self.low_at + begin // 8, (stop + 7) // 8 - begin // 8)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[begin % 8 : begin % 8 + stop - begin]
        weights = np.int64(1) << np.arange(self.low, dtype=np.int64)
        return bits.reshape(-1, self.low).astype(np.int64) @ weights

    def search(self, value: int) -> int:
        """The number of values below the given one."""
        low, high = 0, len(self.samples)
        while low < high:  # kept values below it
            middle = (low + high) // 2
            if int(self.select(middle * SAMPLE, middle * SAMPLE + 1)[0]) < value:
                low = middle + 1
            else:
                high = middle
        if low == 0:
            return 0
        first = (low - 1) * SAMPLE
        return first + int(np.searchsorted(self.select(first, min(self.n, first + SAMPLE)), value))


def _read(file, at: int, size: int) -> bytes:
    file.seek(at)
    return file.read(size)


class TokenFile:
    """One file, opened: boundaries, document ids and ids are read by parts."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        tail = _read(file, size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError("no token-id file")
        length = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(_read(file, size - 12 - length, length))
        self.n_docs, self.n_ids, self.width = (self.footer[k] for k in ("n_docs", "n_ids", "width"))
        self.starts = Sequence(file, self.footer["starts_at"], self.footer["starts"])
        self.doc_ids = Sequence(file, self.footer["docs_at"], self.footer["docs"])

    def documents(self, first: int, last: int) -> pa.Array:
        """Document ids; those without one come first."""
        nulls = self.footer["n_null"]
        known = self.doc_ids.select(max(0, first - nulls), max(0, last - nulls)) + self.footer["least"]
        missing = max(0, min(last, nulls) - first)
        return pa.concat_arrays([pa.nulls(missing, pa.int64()), pa.array(known, pa.int64())])

    def ids(self, begin: int, end: int) -> np.ndarray:
        kind = np.dtype("<u2" if self.width == 2 else "<u4")
        return np.frombuffer(_read(self.file, begin * self.width, (end - begin) * self.width), kind).astype("<u4")

    def batches(self, first: int, last: int, base: int) -> Iterator[pa.RecordBatch]:
        """Documents first to last - 1, some at a time; base is the number of ids in the files before."""
        while first < last:
            begin = int(self.starts.select(first, first + 1)[0])
            stop = max(first + 1, min(last, first + _CHUNK, self.starts.search(begin + BATCH_BYTES // 4)))
            bounds = self.starts.select(first, stop + 1)
            ids = self.ids(begin, int(bounds[-1]))
            offsets = ((bounds - begin) * 4).astype(np.int64)
            payload = pa.Array.from_buffers(
                pa.large_binary(), stop - first, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            ).cast(pa.binary())
            columns = [self.documents(first, stop), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), payload]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])
            first = stop


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: str
    n_docs: int
    n_ids: int


class TokenWriter(DataSourceArrowWriter):
    """Rows (doc_id, ids as 32-bit little-endian binary) of a task, in their order, as one file."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        partition = TaskContext.get().partitionId()
        name = f"part-{partition:06d}-{uuid.uuid4().hex}.ids"
        lengths, docs, n_null = [np.zeros(1, np.int64)], [], 0
        kind = np.dtype("<u2" if self.width == 2 else "<u4")
        with files.open_output_stream(posixpath.join(folder, name)) as out:
            for batch in iterator:
                column = batch.column(batch.schema.get_field_index("ids"))
                ids = np.frombuffer(b"".join(bytes(x.as_buffer()) for x in column), "<u4")
                if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                    raise ValueError(f"an id does not fit in {self.width} bytes")
                out.write(ids.astype(kind).tobytes())
                lengths.append(np.asarray(pa.compute.binary_length(column), dtype=np.int64) // 4)
                known = batch.column(batch.schema.get_field_index("doc_id"))
                n_null += known.null_count
                docs.append(np.asarray(known.drop_null(), dtype=np.int64))
            starts = np.cumsum(np.concatenate(lengths))
            known = np.concatenate(docs) if docs else np.zeros(0, np.int64)
            least = int(known[0]) if len(known) else 0
            n_docs, n_ids = len(starts) - 1, int(starts[-1])
            at = n_ids * self.width
            footer = {"n_docs": n_docs, "n_ids": n_ids, "n_null": n_null, "width": self.width, "least": least}
            footer["spread"] = int(known[-1]) - least if len(known) else 0
            for part, values in (("starts", starts), ("docs", (known - least).view(np.uint64))):
                shape, sections = Sequence.encode(values)
                footer |= {part: shape, f"{part}_at": at}
                out.write(b"".join(sections))
                at += sum(map(len, sections))
            packed = json.dumps(footer).encode()
            out.write(packed + len(packed).to_bytes(4, "little") + MAGIC)
        return Written(partition, name, n_docs, n_ids)

    def commit(self, messages: list) -> None:
        files, folder = open_folder(self.path)
        files.create_dir(folder, recursive=True)
        won = sorted((m for m in messages if m is not None and m.n_docs), key=lambda m: m.partition)
        with files.open_output_stream(posixpath.join(folder, MANIFEST)) as out:
            out.write(json.dumps([[m.file, m.n_docs, m.n_ids] for m in won]).encode())

    def abort(self, messages: list) -> None:
        files, folder = open_folder(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(posixpath.join(folder, m.file))


class TokenReader(DataSourceReader):
    def __init__(self, path: str, width: int, split_bytes: int = SPLIT_BYTES):
        self.path, self.width, self.split_bytes = path, width, split_bytes
        self.least: int | None = None
        self.most: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds on doc_id narrow what is read; Spark still applies them."""
        for f in filters:
            yield f
            if getattr(f, "attribute", None) != ("doc_id",) or not isinstance(getattr(f, "value", None), int):
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                least = f.value + isinstance(f, GreaterThan)
                self.least = least if self.least is None else max(self.least, least)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                most = f.value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(self.most, most)

    def partitions(self) -> list[InputPartition]:
        files, folder = open_folder(self.path)
        with files.open_input_stream(posixpath.join(folder, MANIFEST)) as manifest:
            listed = json.loads(manifest.read())
        found, base, step = [], 0, max(1, self.split_bytes // self.width)
        for name, _, n_ids in listed:
            pieces = max(1, -(-n_ids // step))
            for i in range(pieces):
                found.append(InputPartition((posixpath.join(folder, name), base, i * step, None if i == pieces - 1 else (i + 1) * step)))
            base += n_ids
        return found or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        name, base, begin, end = partition.value
        files, _ = open_folder(self.path)
        with files.open_input_file(name) as raw:
            file = TokenFile(raw)
            first = file.starts.search(begin) if begin else 0
            last = file.n_docs if end is None else min(file.n_docs, file.starts.search(end))
            nulls, offset = file.footer["n_null"], file.footer["least"]
            if file.footer["spread"] < 1 << 63:
                if self.least is not None:
                    first = max(first, nulls + file.doc_ids.search(self.least - offset))
                if self.most is not None:
                    last = min(last, nulls + file.doc_ids.search(self.most - offset + 1))
            yield from file.batches(first, last, base)


class TokenSource(DataSource):
    """spark.read.format("tokenids").load(folder); ids come back as 32-bit little-endian binary."""

    @classmethod
    def name(cls) -> str:
        return "tokenids"

    def schema(self) -> str:
        return SCHEMA

    def _width(self) -> int:
        return int(self.options.get("width", "4"))

    def reader(self, schema: StructType) -> TokenReader:
        return TokenReader(self.options["path"], self._width(), int(self.options.get("splitbytes", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options["path"], self._width())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def encoded(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """(doc_id, ids): each row's ids by the tokenizer file and the end id, in the order of the rows.

    Pre-tokens are merged by the file's own ranks; texts in which the two libraries may differ
    (special strings, characters of unsettled classes) go to the tokenizers library whole.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.here(tokenizer, 0)
        close = np.array([end], "<u4").tobytes()
        for batch in batches:
            for part, texts, wide in decoded(batch):
                direct = [i for i, t in enumerate(texts) if encoder.whole(t, bool(wide[i]))]
                coded = [b"" if i in direct else encoder.ids(t) for i, t in enumerate(texts)] if direct else list(map(encoder.ids, texts))
                for i, ids in zip(direct, encoder.library_ids([texts[i] for i in direct])):
                    coded[i] = np.array(ids, "<u4").tobytes()
                payload = pa.array([c + close for c in coded], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), payload], names=["doc_id", "ids"])

    return docs.mapInArrow(encode, "doc_id long, ids binary")


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end: int, width: int = 2, partitions: int | None = None
) -> None:
    """Write all documents' ids, each with the end id, to folder in ascending doc_id order."""
    register(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order).select("doc_id", "text")
    encoded(ordered, tokenizer, end).write.format("tokenids").option("width", width).mode("append").save(folder)


def read_token_files(spark: SparkSession, folder: str, width: int = 2) -> DataFrame:
    register(spark)
    return spark.read.format("tokenids").option("width", width).load(folder)


def token_files(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None) -> DataFrame:
    """Write the files (to a fresh folder of the shared one if none is given) and read them back."""
    folder = folder or work_path(docs.sparkSession, "token-ids")
    write_token_files(docs, tokenizer, folder, end)
    return read_token_files(docs.sparkSession, folder)
