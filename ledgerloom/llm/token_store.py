"""Token-ID output: Arrow files of fixed-size-list batches, for zero-copy random access to equal-length sequences.

The ids of all documents, each followed by an end id, form one stream in ascending document order. Documents are dealt
into ranges of ids; each task writes its range as a stream of batches into one file after another, so that neither long
texts nor neighbouring ids need memory. A file's part of the stream is cut into sequences of `length` ids. Columns of a
file, one row for each sequence: ids (fixed-size list of uint16, or uint32 for tokenizers of more than 65,536 ids), mask
(fixed-size list of booleans, one bit each, false on the padding of a file's last sequence), doc_id and doc_end (the documents that end in
the sequence, and the places after their last ids). Every batch but a file's last has ROWS sequences, so sequence i is
row i % ROWS of batch i // ROWS, and a memory-mapped reader reaches its ids and mask without decoding or copying.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cluster import carried
from .textblocks import small_batches
from .tokens import encoder

ROWS = 256
#: A file ends with the document that brings it to so many ids.
FILE_IDS = 16 << 20


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class SequenceFile:
    """One file that grows batch by batch; it takes its final name when it is closed."""

    def __init__(self, folder: str, name: str, length: int, kind: pa.DataType, id_kind: pa.DataType):
        self.store, root = _filesystem(folder)
        self.store.create_dir(root, recursive=True)
        self.name, self.path = name, posixpath.join(root, name)
        self.mine = f"{self.path}.{uuid.uuid4().hex}"
        self.length, self.kind = length, kind
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length)), ("doc_id", pa.list_(id_kind)), ("doc_end", pa.list_(pa.int32()))])
        self.out = self.store.open_output_stream(self.mine)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.ids = np.zeros(0, kind.to_pandas_dtype())
        self.ends, self.doc_ids = np.zeros(0, np.int64), pa.array([], id_kind)  # of documents that end in self.ids
        self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, ids: np.ndarray, ends: np.ndarray, doc_ids: pa.Array) -> None:
        """Whole documents: their ids, the place in these after each document's last id, and the documents' ids."""
        self.ends = np.concatenate([self.ends, ends + len(self.ids)])
        self.doc_ids = pa.concat_arrays([self.doc_ids, doc_ids])
        self.ids = np.concatenate([self.ids, ids])
        self.n_docs, self.n_tokens = self.n_docs + len(ends), self.n_tokens + len(ids)
        whole = len(self.ids) // (ROWS * self.length)
        for _ in range(whole):
            self._batch(ROWS)

    def _batch(self, n: int) -> None:
        """Write the next n sequences, the last one padded."""
        size = n * self.length
        own, real = self.ids[:size], min(size, len(self.ids))
        if real < size:
            own = np.concatenate([own, np.zeros(size - real, own.dtype)])
        mask = np.zeros(size, np.uint8)
        mask[:real] = 1
        upto = int(np.searchsorted(self.ends, real, side="right"))
        ends = self.ends[:upto]
        row = (ends - 1) // self.length
        offsets = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(own, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.Array.from_buffers(pa.bool_(), size, [None, pa.py_buffer(np.packbits(mask, bitorder="little"))]), self.length),
            pa.ListArray.from_arrays(offsets, self.doc_ids[:upto]),
            pa.ListArray.from_arrays(offsets, pa.array((ends - row * self.length).astype(np.int32))),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.ids, self.ends, self.doc_ids = self.ids[real:], self.ends[upto:] - real, self.doc_ids[upto:]
        self.n_sequences += n

    def close(self) -> None:
        if len(self.ids):
            self._batch(-(-len(self.ids) // self.length))
        self.writer.close()
        self.out.close()
        self.store.move(self.mine, self.path)


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end_id: int, drops_space: bool, length: int = 2048, id_col: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write docs' ids below `folder` and return the manifest (file_no, path, n_docs, n_sequences, n_tokens).

    `folder` must be shared by driver and executors. Files cover ranges of ascending ids, as many ranges as
    spark.sql.shuffle.partitions says; null ids come first, rows of one id in no set order but each whole. Null and empty
    texts give the end id alone; a very long text is one document of one file. A retried task writes its files anew under
    other names before they take the final ones. Other columns are not read. An empty table gives no file and an empty
    manifest.
    """
    if length % 8:
        raise ValueError("a sequence's length must be a multiple of 8")
    spark = carried(docs).sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, drops_space)
        kind = pa.uint16() if max(own.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else pa.uint32()
        part, n, file = TaskContext.get().partitionId(), 0, None
        fields = [pa.field("file_no", pa.int64()), pa.field("path", pa.string()), pa.field("n_docs", pa.int64()), pa.field("n_sequences", pa.int64()), pa.field("n_tokens", pa.int64())]

        def line() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file_no": (part << 24) + n, "path": file.name, "n_docs": file.n_docs, "n_sequences": file.n_sequences, "n_tokens": file.n_tokens}], schema=pa.schema(fields))

        for batch in small_batches(batches, "text", 3 << 20):
            ids, counts = own.encode(batch.column(1))
            stop = np.cumsum(counts + 1)
            flat = np.full(int(stop[-1]), end_id, kind.to_pandas_dtype())
            inside = np.ones(len(flat), bool)
            inside[stop - 1] = False
            flat[inside] = ids
            file = file or SequenceFile(folder, f"part-{part:06d}-{n:06d}.arrow", length, kind, batch.column(0).type)
            file.add(flat, stop, batch.column(0))
            if file.n_tokens >= file_ids:
                file.close()
                yield line()
                file, n = None, n + 1
        if file:
            file.close()
            yield line()

    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    dealt = own.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    manifest = dealt.mapInArrow(write, "file_no long, path string, n_docs long, n_sequences long, n_tokens long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def open_file(folder: str, path: str) -> tuple[pa.ipc.RecordBatchFileReader, object]:
    """Reader of one file; local files are mapped, so that batches are views of the file."""
    store, root = _filesystem(folder)
    full = posixpath.join(root, path)
    source = pa.memory_map(full) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(full)
    return pa.ipc.open_file(source), source


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of sequence i of a file, both views of the file's bytes; the mask has eight sequence places in a byte,
    the first one in its lowest bit."""
    batch = reader.get_batch(i // ROWS)
    length = batch.schema.field("ids").type.list_size
    at = (i % ROWS) * length
    return batch.column(0).values.to_numpy()[at : at + length], np.frombuffer(batch.column(1).values.buffers()[1], np.uint8)[at // 8 : (at + length) // 8]


def read_documents(spark: SparkSession, folder: str, id_kind: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that the manifest names."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = manifest.select("file_no", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                reader, source = open_file(folder, path)
                head = np.zeros(0, np.uint32)
                start = base
                for i in range(reader.num_record_batches):
                    rows = reader.get_batch(i)
                    length = rows.schema.field("ids").type.list_size
                    real = rows.column(1).values.to_numpy(zero_copy_only=False)
                    ids = np.concatenate([head, rows.column(0).values.to_numpy()[real].astype("<u4")])
                    seq = np.repeat(np.arange(rows.num_rows), rows.column(3).value_lengths().to_numpy())
                    ends = rows.column(3).values.to_numpy() + seq * length + len(head)
                    begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                    raw = memoryview(ids).cast("B") if len(ids) else memoryview(b"")
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(2).values, pa.array(begin + start, pa.int64()), pa.array(ends - begin, pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    last = int(ends[-1]) if len(ends) else 0
                    head, start = ids[last:], start + last
                source.close()

    n = max(1, manifest.count())
    return carried(files).repartition(n, "file_no").mapInArrow(read, f"doc_id {id_kind}, start long, n_tokens long, ids_crc32 long")
