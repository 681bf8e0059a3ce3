"""Token sequences of equal length in Arrow stream files, with random access that copies nothing.

The ids of all documents, in key order and an end id after each, are one long
row that is cut into sequences of ``length`` ids. A file holds the sequences of
one range of keys as an Arrow stream of record batches with two fixed-size-list
columns, ``ids`` (unsigned integers) and ``mask`` (booleans, false for the
padding after the last document of a file). All batches but the last have the
same number of sequences, so they have the same size in bytes: where sequence i
lies follows from i, and a mapped file gives it as a view. A second stream beside
it holds key and length of each document; a manifest lists the files in order.

A file is written under a name of its own by each attempt of a task, and only the
files of the attempts that Spark commits enter the manifest, which is written
last. So lost executors and repeated tasks leave nothing in the result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.llm.tokens import encoder

LENGTH = 2048
#: Sequences of one record batch.
BATCH = 64
FORMAT = "token_sequences"
MANIFEST = "manifest.json"
#: Ids that the reader of documents hands on at a time.
HANDED = 1 << 21


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a path or an address (``file:``, ``hdfs:``, ``s3:`` ...)."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def sequence_schema(length: int, kind: np.dtype) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceFile:
    """Random access to the sequences of one file.

    On a local file system the file is mapped and what is returned are views of
    the mapping; others read the one batch that is asked for.
    """

    def __init__(self, path: str):
        fs, name = storage(path)
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else fs.open_input_file(name)
        self.schema = pa.ipc.read_schema(self.source)
        self.length = self.schema.field("ids").type.list_size
        self.start = self.source.tell()
        end = self.source.size()
        try:
            self.rows = self._batch_at(self.start).num_rows
        except EOFError:
            self.rows, self.step, self.batches = 0, 1, 0
            return
        self.step = self.source.tell() - self.start
        # A shorter batch can only be the last one; the end mark is shorter than any batch.
        self.batches = -(-(end - self.start - 8) // self.step)

    def _batch_at(self, place: int) -> pa.RecordBatch:
        self.source.seek(place)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def batch(self, i: int) -> pa.RecordBatch:
        if not 0 <= i < self.batches:
            raise IndexError(i)
        return self._batch_at(self.start + i * self.step)

    def __len__(self) -> int:
        return (self.batches - 1) * self.rows + self.batch(self.batches - 1).num_rows if self.batches else 0

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask (an Arrow array over the same memory) of sequence ``i``."""
        if i < 0 or not self.batches:
            raise IndexError(i)
        batch, row = self.batch(i // self.rows), i % self.rows
        if row >= batch.num_rows:
            raise IndexError(i)
        lo, hi = row * self.length, (row + 1) * self.length
        return batch.column(0).values.to_numpy(zero_copy_only=True)[lo:hi], batch.column(1).values.slice(lo, self.length)


class _Sequences:
    """Writes ids as they come, in batches of full sequences."""

    def __init__(self, fs: pafs.FileSystem, name: str, length: int, kind: np.dtype):
        self.schema, self.length, self.kind = sequence_schema(length, kind), length, kind
        self.stream = fs.open_output_stream(name)
        self.writer = pa.ipc.new_stream(self.stream, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = self.count = self.sequences = 0

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        values = [pa.array(np.ascontiguousarray(ids)), pa.array(mask)]
        columns = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in values]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.sequences += len(ids) // self.length

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.held += len(ids)
        self.count += len(ids)
        full = self.length * BATCH
        if self.held >= full:
            ids = np.concatenate(self.parts)
            whole = len(ids) // full * full
            for at in range(0, whole, full):
                self._write(ids[at : at + full], full)
            self.parts, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        if self.held:
            size = -(-self.held // self.length) * self.length
            ids = np.zeros(size, dtype=self.kind)
            ids[: self.held] = np.concatenate(self.parts)
            self._write(ids, self.held)
        self.writer.close()
        self.stream.close()


@dataclass
class _Written(WriterCommitMessage):
    part: int
    name: str | None
    tokens: int = 0
    documents: int = 0
    sequences: int = 0


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.tokenizer = options["path"], options["tokenizer"]
        self.end, self.length = int(options["end"]), int(options.get("length", LENGTH))
        self.schema = schema.json()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        part, tokens = TaskContext.get().partitionId(), encoder(self.tokenizer)
        fs, folder = storage(self.path)
        name, out, index, beside = f"part-{part:06d}-{uuid.uuid4().hex}", None, None, None
        documents = 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = _Sequences(fs, f"{folder}/{name}.arrows", self.length, tokens.kind)
                beside = fs.open_output_stream(f"{folder}/{name}.documents.arrows")
                index = pa.ipc.new_stream(beside, index_schema(batch))
            for lo, hi, ids, ends in tokens.encode(batch.column(1)):
                # The end id goes in at the end of every row.
                out.add(np.insert(ids, ends[1:], self.end))
                lengths = pa.array(np.diff(ends) + 1)
                index.write_batch(pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lengths], schema=index_schema(batch)))
                documents += hi - lo
        if out is None:
            return _Written(part, None)
        index.close()
        beside.close()
        out.close()
        return _Written(part, name, out.count, documents, out.sequences)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = storage(self.path)
        fs.create_dir(folder, recursive=True)
        kept = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.part)
        files = [{"name": m.name, "tokens": m.tokens, "documents": m.documents, "sequences": m.sequences} for m in kept]
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"schema": self.schema, "length": self.length, "files": files}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = storage(self.path)
        for m in messages:
            if m is not None and m.name:
                for end in ("arrows", "documents.arrows"):
                    fs.delete_file(f"{folder}/{m.name}.{end}")


def index_schema(batch: pa.RecordBatch) -> pa.Schema:
    return pa.schema([batch.schema.field(0).with_name("key"), ("length", pa.int64())])


def manifest(path: str) -> dict:
    """Files of a folder in order, with their tokens, documents and sequences."""
    fs, folder = storage(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as lines:
        return json.loads(lines.read())


class _File(InputPartition):
    def __init__(self, name: str | None, tokens: int, sequences: int):
        self.name, self.tokens, self.sequences = name, tokens, sequences


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], options.get("rows", "sequences")

    def partitions(self) -> list[InputPartition]:
        out, tokens, sequences = [], 0, 0
        for f in manifest(self.path)["files"]:
            out.append(_File(f["name"], tokens, sequences))
            tokens, sequences = tokens + f["tokens"], sequences + f["sequences"]
        return out or [_File(None, 0, 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition.name is None:
            return
        yield from (self._documents if self.rows == "documents" else self._sequences)(partition)

    def _sequences(self, partition: _File) -> Iterator[pa.RecordBatch]:
        file, at = SequenceFile(f"{self.path}/{partition.name}.arrows"), partition.sequences
        for i in range(file.batches):
            batch = file.batch(i)
            number = pa.array(np.arange(at, at + len(batch), dtype=np.int64))
            at += len(batch)
            ids, mask = batch.columns
            yield pa.RecordBatch.from_arrays(
                [number, ids.cast(pa.list_(pa.int64())), mask.cast(pa.list_(pa.bool_()))], ["sequence", "ids", "mask"]
            )

    def _documents(self, partition: _File) -> Iterator[pa.RecordBatch]:
        file, (fs, folder) = SequenceFile(f"{self.path}/{partition.name}.arrows"), storage(self.path)
        held, have, at, batch = [], 0, partition.tokens, 0
        with fs.open_input_stream(f"{folder}/{partition.name}.documents.arrows") as beside:
            for index in pa.ipc.open_stream(beside):
                sizes = index.column(1).to_numpy()
                row = 0
                while row < len(index):
                    ends = np.cumsum(sizes[row:])
                    n = max(int(np.searchsorted(ends, HANDED, side="right")), 1)
                    wanted = int(ends[n - 1])
                    while have < wanted:
                        found = file.batch(batch)
                        ids, mask = (c.values.to_numpy(zero_copy_only=False) for c in found.columns)
                        # Only the last batch of a file has padding.
                        held.append(ids if batch + 1 < file.batches else ids[mask])
                        have, batch = have + len(held[-1]), batch + 1
                    ids = np.concatenate(held)
                    held, have = [ids[wanted:]], have - wanted
                    lengths = sizes[row : row + n]
                    starts = at + np.cumsum(lengths) - lengths
                    at += wanted
                    edges = np.concatenate([[0], ends[:n]]).astype(np.int64) * 4
                    whole = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(edges), pa.py_buffer(ids[:wanted].astype("<u4"))])
                    yield pa.RecordBatch.from_arrays(
                        [index.column(0).slice(row, n), pa.array(starts), pa.array(lengths), whole.cast(pa.binary())],
                        ["key", "start", "length", "ids"],
                    )
                    row += n


class TokenSequences(DataSource):
    """Data source ``token_sequences``.

    Writing takes rows ``(key, text)`` whose partitions are ranges of sorted keys,
    with the options ``tokenizer``, ``end`` and ``length``. Reading gives
    ``sequence, ids, mask``, or, with ``rows`` set to ``documents``, ``key,
    start, length, ids`` (the ids as little-endian unsigned 32-bit integers).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType | str:
        if self.options.get("rows", "sequences") != "documents":
            return "sequence bigint, ids array<bigint>, mask array<boolean>"
        key = StructType.fromJson(json.loads(manifest(self.options["path"])["schema"]))[0]
        return StructType().add("key", key.dataType).add("start", "long").add("length", "long").add("ids", "binary")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), schema)


def write_sequences(
    docs: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", length: int = LENGTH, files: int | None = None
) -> None:
    """Write the texts as token sequences in key order to a new folder that all executors share.

    Null keys come first; rows of one key follow a digest of their text; repeated
    rows are written as often as they come. A null text is empty, and an empty
    one is its end id. ``files`` defaults to the session's shuffle partitions. An
    empty table gives a manifest without files. A range of keys is bounded by
    rows drawn at random; as rows of one key go on by digest and place, one key
    of any share lies in many files.
    """
    spark = docs.sparkSession
    spark.dataSource.register(TokenSequences)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("key", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("place"))
    order = [F.asc_nulls_first("key"), "digest", "place"]
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("key", "text")
    options = {"tokenizer": tokenizer, "end": str(end), "length": str(length)}
    dealt.write.format(FORMAT).options(**options).mode("append").save(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``key, start, length, ids`` of every document, from the files."""
    spark.dataSource.register(TokenSequences)
    return spark.read.format(FORMAT).option("rows", "documents").load(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``sequence, ids, mask`` of every sequence, from the files."""
    spark.dataSource.register(TokenSequences)
    return spark.read.format(FORMAT).load(path)
