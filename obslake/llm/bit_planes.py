"""Token ids as binary files of compressed bit or byte planes.

Documents are range-partitioned and sorted by id; each task tokenizes its
range and writes one file.  A file is a row of blocks of ``block`` ids (the
last may be shorter); a block is transposed into byte planes (all lowest
bytes, all second bytes, ...) or bit planes, and each plane is a zstandard
frame.  Planes of zeros take no bytes.  Layout of a file:

    magic | planes of block 0 | planes of block 1 | ...
          | document table | chunk index | fixed footer

The document table has ids and lengths; the chunk index has for each block
its place, its number of ids and the sizes of its planes, so any block can
be read alone.  The footer gives the places of table and index.

Files go to the folder given (a URI that every executor reaches), under a
temporary name until complete: a task that runs again writes the same bytes
under the same name.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import utf8
from obslake.llm.tokens import encoder

MAGIC = b"IDPLANE1"
FOOTER = struct.Struct("<QQQQQB7x8s")  # table at, its size, index at, its size, blocks, bit planes?, magic
BLOCK = 1 << 16
FILE_BYTES = 1 << 28  # text of a file
PART_IDS = 1 << 24  # ids of a file that a task reads
MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def filesystem(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of little-endian unsigned 32-bit ids, lowest first; all-zero
    planes are empty."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(octets.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    rows = np.zeros((len(planes), -(-n // 8) if bits else n), dtype=np.uint8)
    for row, plane in zip(rows, planes):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    if bits:
        octets = np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :n].T, axis=1, bitorder="little")
    else:
        octets = np.ascontiguousarray(rows.T)
    return octets.reshape(-1).view("<u4")


class Writer:
    def __init__(self, sink, bits: bool, block: int):
        self.sink, self.bits, self.block = sink, bits, block
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.at = self.n_ids = 0
        self.waiting = bytearray()
        self.docs: list[tuple[int | None, int]] = []
        self.index: list[int] = []
        self.blocks = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def _block(self, data: bytes) -> None:
        planes = [self.compress(p) if p else b"" for p in to_planes(np.frombuffer(data, "<u4"), self.bits)]
        self.index += [self.at, len(data) // 4, *map(len, planes)]
        self.blocks += 1
        self._put(b"".join(planes))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.waiting += ids
        size = 4 * self.block
        done = len(self.waiting) // size * size
        for at in range(0, done, size):
            self._block(bytes(self.waiting[at:at + size]))
        del self.waiting[:done]

    def close(self) -> None:
        if self.waiting:
            self._block(bytes(self.waiting))
        known = np.array([d is not None for d, _ in self.docs], dtype=np.uint8)
        table = np.array([(d or 0, n) for d, n in self.docs], dtype="<i8").reshape(-1, 2)
        table = self.compress(struct.pack("<Q", len(known)) + known.tobytes() + table.T.tobytes())
        index = self.compress(np.array(self.index, dtype="<u8").tobytes())
        at = self.at
        self._put(table + index)
        self._put(FOOTER.pack(at, len(table), at + len(table), len(index), self.blocks, self.bits, MAGIC))


class Reader:
    """Documents of one file in order, block by block."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        at, n, index_at, index_n, self.blocks, self.bits, magic = FOOTER.unpack(
            source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token planes")
        self.expand = zstandard.ZstdDecompressor().decompress
        table = self.expand(source.read_at(n, at))
        (docs,) = struct.unpack_from("<Q", table)
        known = np.frombuffer(table, np.uint8, docs, 8)
        ids, lengths = np.frombuffer(table, "<i8", 2 * docs, 8 + docs).reshape(2, docs)
        self.docs = [(int(d) if k else None, int(m)) for k, d, m in zip(known, ids, lengths)]
        self.index = np.frombuffer(self.expand(source.read_at(index_n, index_at)), "<u8").reshape(self.blocks, -1)

    def block(self, k: int) -> bytes:
        at, n, *sizes = map(int, self.index[k])
        data, planes = self.source.read_at(sum(sizes), at), []
        for size in sizes:
            planes.append(self.expand(data[:size]) if size else b"")
            data = data[size:]
        return from_planes(planes, n, self.bits).tobytes()

    def documents(self, low: int = 0, high: int | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """doc_id, start in the file and ids of the documents that start from
        ``low`` to before ``high``; only the blocks that hold them are read."""
        starts = np.cumsum([0, *[n for _, n in self.docs]])
        first, last = np.searchsorted(starts[:-1], [low, starts[-1] if high is None else high]).tolist()
        if first == last:
            return
        ends = np.cumsum(self.index[:, 1].astype(np.int64))
        k = int(np.searchsorted(ends, starts[first], side="right"))
        have = bytearray()
        skip = 4 * int(starts[first] - (ends[k - 1] if k else 0))
        for (doc_id, n), start in zip(self.docs[first:last], starts[first:last].tolist()):
            while len(have) < skip + 4 * n:
                have += self.block(k)
                k += 1
            yield doc_id, start, bytes(have[skip:skip + 4 * n])
            del have[:skip + 4 * n]
            skip = 0

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        return ((doc_id, ids) for doc_id, _, ids in self.documents())


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
                      planes: str = "byte", block: int = BLOCK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files under ``folder`` in
    ascending doc_id order and return the manifest: one row per file, in
    order, with ``first`` (the number of ids in the files before it).  A file
    holds about ``file_bytes`` of text at most.

    Null or empty text: the end id alone.  Null doc_ids come first; rows that
    repeat an id are written once each, ordered by text.  An empty table
    writes no file.  Other columns are ignored.  The manifest has one row
    per task that had rows, which bounds what the driver sees of the job.
    """
    if planes not in ("byte", "bit"):
        raise ValueError("planes are byte or bit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()
        shard, writer = TaskContext.get().partitionId(), None
        store, base = filesystem(folder)
        path, draft = f"{base}/ids-{shard:06d}.planes", f"{base}/draft-{uuid.uuid4().hex}"
        for batch in batches:
            for doc, text in zip(batch.column(0), utf8(batch.column(1))):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    writer = Writer(store.open_output_stream(draft), planes == "bit", block)
                writer.add(doc.as_py(), encode(text) + end)
        if writer is not None:
            writer.close()
            writer.sink.close()
            store.move(draft, path)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/ids-{shard:06d}.planes"],
                "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    spark = docs.sparkSession
    text_key = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text"), text_key.alias("k"))
    n_files = -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // file_bytes)
    # a setting says how many ranges there are; a large table needs more
    more = [n_files] if n_files > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    files = (rows.repartitionByRange(*more, F.col("doc_id"), F.col("k"))
             .sortWithinPartitions("doc_id", "k", "text").select("doc_id", "text")
             .mapInArrow(run, MANIFEST).collect())
    first, rows = 0, []
    for f in sorted(files, key=lambda f: f.shard):
        rows.append((f.shard, f.path, f.n_docs, f.n_ids, first))
        first += f.n_ids
    return spark.createDataFrame(rows, MANIFEST + ", first bigint")


def read_token_files(manifest: DataFrame, part_ids: int = PART_IDS) -> DataFrame:
    """Documents of the files of a manifest: ``doc_id, start`` (ids of all
    documents before it), ``n_tokens, ids`` (little-endian unsigned 32-bit).

    A file is read in parts of about ``part_ids`` ids by different tasks: the
    chunk index says which blocks hold a part's documents.  A task holds one
    block and one document, and the file's table of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, part in zip(*[c.to_pylist() for c in batch.columns]):
                store, name = filesystem(path)
                rows: list[tuple] = []
                size = 0
                with store.open_input_file(name) as source:
                    for doc_id, start, ids in Reader(source).documents(part * part_ids, (part + 1) * part_ids):
                        rows.append((doc_id, first + start, len(ids) // 4, ids))
                        size += len(ids)
                        if size >= 1 << 23:
                            yield _rows(rows)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)],
                                          ["doc_id", "start", "n_tokens", "ids"])

    last = F.floor((F.col("n_ids") - 1) / part_ids)
    parts = manifest.select("path", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("part"))
    return parts.repartition(max(1, parts.count())).mapInArrow(run, ROWS)


def token_file_round_trip(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, **kw) -> DataFrame:
    return read_token_files(write_token_files(docs, folder, tokenizer, **kw))
