"""Token-id files: one zstandard frame per document, a document index and a trailing seek table.

A shard file is a sequence of independent zstandard frames, each the little-endian
uint32 ids of one document with a content checksum.  Two skippable frames follow:
the document index (int64 ids of the documents in frame order, with a null flag)
and the seek table in the public seekable layout (compressed size, decompressed
size and a 32-bit checksum for each frame; count, flags and magic at the very end).
A plain ``zstd -d`` of the file gives all ids; ``ShardReader`` reads the two tables
from the end of the file and decompresses only the frames that are asked for.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkfold.llm import scratch
from sparkfold.llm.chunk_encode import encoder, slices

# Fixed values of the public seekable zstandard layout.
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEK_MAGIC = 0x8F92EAB1
SEEK_FLAGS = 0x80  # each entry has a checksum
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
INDEXED = np.dtype([("doc_id", "<i8"), ("is_null", "u1")])
READ_BYTES = 8 << 20


def open_store(path: str):
    """(file system, path in it) of a URI or local path, without a Spark session."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard file document by document; memory: 21 bytes a document."""

    def __init__(self, path: str, level: int = 3):
        store, inner = open_store(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(inner, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        frame = self.packer.compress(data)
        self.out.write(frame)
        self.entries.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.ids.append((0, 1) if doc_id is None else (doc_id, 0))

    def close(self) -> None:
        index = np.array(self.ids, dtype=INDEXED).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = np.array(self.entries, dtype=ENTRY).tobytes() + struct.pack("<IBI", len(self.entries), SEEK_FLAGS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        self.out.close()


class ShardReader:
    """Reads a shard's tables on opening; ``read`` then fetches single documents, ``scan`` all in order."""

    def __init__(self, path: str):
        store, inner = open_store(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags != SEEK_FLAGS:
            raise ValueError(f"{path}: no seek table")
        table = 9 + count * ENTRY.itemsize
        at = size - table - 8
        if struct.unpack("<II", self.file.read_at(8, at)) != (SKIPPABLE_SEEK, table):
            raise ValueError(f"{path}: damaged seek table")
        self.entries = np.frombuffer(self.file.read_at(table - 9, at + 8), dtype=ENTRY)
        index = count * INDEXED.itemsize
        if struct.unpack("<II", self.file.read_at(8, at - index - 8)) != (SKIPPABLE_INDEX, index):
            raise ValueError(f"{path}: damaged document index")
        self.index = np.frombuffer(self.file.read_at(index, at - index), dtype=INDEXED)
        self.at = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        self.unpacker = zstandard.ZstdDecompressor()

    def doc_id(self, k: int) -> int | None:
        return None if self.index["is_null"][k] else int(self.index["doc_id"][k])

    def _open(self, k: int, frame: bytes) -> bytes:
        data = self.unpacker.decompress(frame, max_output_size=int(self.entries["plain"][k]))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.entries["check"][k]:
            raise ValueError(f"frame {k} fails its checksum")
        return data

    def read(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(doc_id, ids) of the asked documents that lie here; only their frames are fetched and opened."""
        asked = np.isin(self.index["doc_id"], np.fromiter(doc_ids, dtype=np.int64)) & (self.index["is_null"] == 0)
        for k in np.flatnonzero(asked).tolist():
            yield self.doc_id(k), self._open(k, self.file.read_at(int(self.entries["packed"][k]), int(self.at[k])))

    def scan(self) -> Iterator[tuple[int | None, bytes]]:
        """All documents in order, from reads of about ``READ_BYTES``."""
        k = 0
        while k < len(self.entries):
            end = max(k + 1, int(np.searchsorted(self.at, self.at[k] + READ_BYTES, side="right")) - 1)
            chunk = self.file.read_at(int(self.at[end] - self.at[k]), int(self.at[k]))
            for i in range(k, end):
                lo = int(self.at[i] - self.at[k])
                yield self.doc_id(i), self._open(i, chunk[lo:lo + int(self.entries["packed"][i])])
            k = end

    def close(self) -> None:
        self.file.close()


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int, keeps_space: bool = False) -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id``, write shards in ascending doc_id order.

    One range partition is one shard.  A retried task writes another file; the
    manifest (shard, path, n_docs, n_tokens) names the files of the tasks that
    Spark committed.  Rows of one doc_id stand together, ordered by text; null
    ids come first; an empty table gives no shard.
    """
    rows = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange("doc_id", F.crc32(F.col("text")))
            .sortWithinPartitions("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, keeps_space).encode, struct.pack("<I", end_id)
        shard, n_docs, n_tokens, out, path = TaskContext.get().partitionId(), 0, 0, None, ""
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                for doc_id, data in zip(ids[lo:hi], encode(texts[lo:hi])):
                    if out is None:
                        path = f"{folder}/shard-{shard:07d}-{uuid.uuid4().hex}.zst"
                        out = ShardWriter(path)
                    out.add(doc_id, data + end)
                    n_docs, n_tokens = n_docs + 1, n_tokens + len(data) // 4 + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    return scratch.stored(rows.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long"), "manifest")


def read_shards(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the shard files; ``doc_ids``: only those documents' frames are opened
    (``start`` is then null).  ``ids`` is the little-endian uint32 bytes, end id included."""
    # one row a shard: the running total over shards is a small table
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start"))
    spread = files.repartition(max(1, manifest.count()), "path")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                reader, rows, size = ShardReader(path), [], 0
                for doc_id, data in reader.scan() if doc_ids is None else reader.read(doc_ids):
                    rows.append((doc_id, start if doc_ids is None else None, len(data) // 4, data))
                    start, size = start + len(data) // 4, size + len(data)
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                reader.close()

    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write the token files of ``docs`` to shared storage and read them back."""
    return read_shards(write_shards(docs, scratch.folder(spark, "tokens"), vocabulary, end_id))
