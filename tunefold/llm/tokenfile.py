"""Token ids in Arrow files of fixed-size-list batches, written by tasks and read in place (operator 8).

Documents are dealt by ranges of (doc_id, start of the text, place) and sorted; each task tokenizes its
range and writes one shard: an Arrow IPC file whose record batches have two
columns of fixed-size lists, ``ids`` (uint16 where the vocabulary allows it, else
uint32) and ``mask`` (bits: set for an id, not for the padding after a shard's
last one). Sequence ``i`` of a shard is row
``i % ROWS`` of batch ``i // ROWS``, so a reader that maps the file gets any
sequence and its mask as views of the mapped bytes, without copying. A second
file beside it, of the same kind, lists the shard's documents with their start
and length.

A task writes to names of its own attempt and returns them; the manifest, a
table that Spark commits once, names the shards that count. So a lost executor,
a repeated or a speculative attempt leaves files that no manifest names and
nothing else. A shard's place among all ids is the sum of the shards before it
in the manifest (one row a shard).

Files go to the folder in ``spark.checkpoint.dir`` through ``pyarrow.fs``, which
knows file, hdfs, s3 and gs addresses; the input is read by Spark alone.

Rows: null text counts as empty (the end id alone); rows of a null doc_id come
first; rows with equal doc_ids are ordered by text and each kept; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunefold.llm.common import batches, written
from tunefold.session import scratch_path
from tunefold.llm.tokens import encoder

#: Ids of a sequence and sequences of a record batch.
LENGTH, ROWS = 2048, 64
#: Characters of a text by which rows of one doc_id are dealt.
PREFIX = 48

MANIFEST = "path string, index string, part int, n_docs long, n_tokens long, n_sequences long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _schema(length: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


def opened(path: str, write: bool = False):
    """An Arrow file for an address; a local one is mapped when read."""
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    if write:
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        return fs.open_output_stream(at)
    return pa.memory_map(at) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(at)


def qualified(spark: SparkSession, path: str) -> str:
    """The address of a folder; one without a scheme lies in Spark's default file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


class ShardWriter:
    """Writes ids, of any number at a time, as equal sequences; holds less than one batch in memory."""

    def __init__(self, sink, length: int = LENGTH, rows: int = ROWS, dtype: type = np.uint32):
        self.length, self.rows, self.held, self.n = length, rows, [], 0
        self.total = self.sequences = 0
        self.schema, self.dtype = _schema(length, np.dtype(dtype)), dtype
        self.out = pa.ipc.new_file(sink, self.schema)

    def write(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n += len(ids)
        self.total += len(ids)
        size = self.length * self.rows
        if self.n >= size:
            have = np.concatenate(self.held)
            for k in range(0, len(have) - size + 1, size):
                self._batch(have[k : k + size], size)
            self.held = [have[len(have) // size * size :]]
            self.n = len(self.held[0])

    def _batch(self, ids: np.ndarray, n: int) -> None:
        of = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(a), self.length)
        self.out.write_batch(pa.record_batch([of(ids), of(np.arange(len(ids)) < n)], schema=self.schema))
        self.sequences += len(ids) // self.length

    def close(self) -> None:
        if self.n:
            ids = np.concatenate(self.held)
            self._batch(np.r_[ids, np.zeros(-len(ids) % self.length, self.dtype)].astype(self.dtype), len(ids))
        self.out.close()


class Shard:
    """Random access to a shard's sequences and spans of ids."""

    def __init__(self, path: str):
        self.file = pa.ipc.open_file(opened(path))
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def _flat(self, batch: int) -> np.ndarray:
        return self.file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids (numpy) and mask (Arrow bits) of sequence ``i``: views, not copies."""
        b, r = divmod(i, self.rows)
        mask = self.file.get_batch(b).column(1).flatten().slice(r * self.length, self.length)
        return self._flat(b)[r * self.length : (r + 1) * self.length], mask

    def spans(self, starts_and_lengths) -> Iterator[np.ndarray]:
        """Ids of spans in ascending order; one batch is open at a time, and only a span over its end is copied."""
        size, at, flat = self.rows * self.length, -1, None
        for start, n in starts_and_lengths:
            parts = []
            while n > 0:
                b, r = divmod(start, size)
                if b != at:
                    at, flat = b, self._flat(b)
                parts.append(flat[r : r + n])
                n -= len(parts[-1])
                start += len(parts[-1])
            yield parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 1, length: int = LENGTH) -> DataFrame:
    """Writes shards under ``folder`` and returns the manifest (``path``: tokenizer file)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
        name = f"{folder}/{uuid.uuid4().hex}"  # an attempt's own
        out = None
        docs_n, part = 0, 0
        for b in batches(parts, 500_000):
            if out is None:
                part = TaskContext.get().partitionId()
                sink, index_sink = opened(f"{name}.arrow", True), opened(f"{name}.docs.arrow", True)
                dtype = np.uint16 if max(enc.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
                out, index = ShardWriter(sink, length, dtype=dtype), pa.ipc.new_file(index_sink, _INDEX)
            ids = [x + end for x in enc.encode([t or "" for t in b.column(1).to_pylist()])]
            starts = []
            for x in ids:
                starts.append(out.total)
                out.write(np.frombuffer(x, "<u4"))
            counts = [len(x) // 4 for x in ids]
            index.write_batch(pa.record_batch([b.column(0).cast(pa.int64()), starts, counts], schema=_INDEX))
            docs_n += b.num_rows
        if out is not None:
            out.close(), sink.close(), index.close(), index_sink.close()
            row = (f"{name}.arrow", f"{name}.docs.arrow", part, docs_n, out.total, out.sequences)
            types = [pa.string()] * 2 + [pa.int32()] + [pa.int64()] * 3
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # rows of one doc_id are cut by their texts, and equal ones by their place in the input
    start, place = F.substring("text", 1, PREFIX), F.monotonically_increasing_id().alias("place")
    dealt = rows.select("*", place).repartitionByRange(n, F.col("doc_id"), start, F.col("place"))
    dealt = dealt.sortWithinPartitions("doc_id", "text").select("doc_id", "text")
    return written(dealt.mapInArrow(run, MANIFEST), "token-manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with each shard's place among all ids; the window is over one row a shard.

    Ranges are numbered in ascending order, also those that a frequent doc_id is spread over.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: place among all ids, length and checksum of its ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts:
            for m in p.to_pylist():
                shard, index = Shard(m["path"]), pa.ipc.open_file(opened(m["index"]))
                for k in range(index.num_record_batches):
                    b = index.get_batch(k)
                    starts, counts = b.column(1).to_numpy(), b.column(2).to_numpy()
                    crc = [zlib.crc32(s.astype("<u4")) for s in shard.spans(zip(starts, counts))]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0), pa.array(starts + m["shard_start"]), b.column(2), pa.array(crc, pa.int64())],
                        names=[c.split()[0] for c in schema.split(", ")],
                    )

    shards = written(placed(manifest).select("path", "index", "shard_start"), "token-shards")
    # One row a shard; each shard is read by a task of its own.
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n).mapInArrow(run, schema)


def token_files(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Writes a token file set into the shared folder and reads every document back from it."""
    return read_tokens(write_tokens(docs, path, qualified(spark, scratch_path(spark, "tokens"))))
