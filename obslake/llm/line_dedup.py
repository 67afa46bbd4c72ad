"""Exact line deduplication with keep bitmaps.

Line keys are hashed to 128 bits (taken as the key from then on).  The rows
(hash, document, row, position) are range-partitioned by all of them and
sorted, so each task streams its rows and the first document of a hash is
the first one met; later documents lose the line.  As the range bounds
include document and position, the rows of one very common line spread over
many tasks; what a task cannot know, whether its first hash began in an
earlier one, is settled from two boundary rows per task.

The result is one compressed bitmap per document that loses lines, not text;
:func:`apply_bitmaps` puts bitmaps to texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.llm.common import NO_ID, packed, utf8, written

WHITE = b" \t\n\x0b\x0c\r"
LINES = "h1 bigint, h2 bigint, d bigint, k bigint, pos int"
DROP, OPEN, EDGE = 0, 1, 2
ROWS_OUT = 50_000


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def _identity(docs: DataFrame) -> list[Column]:
    """Documents are told apart by id (null after all others), rows that
    share an id by text."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("d"), F.xxhash64("text").alias("k")]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for d, k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))):
                for pos, line in enumerate(text.split(b"\n")):
                    key = line.strip(WHITE)
                    if len(key) >= min_chars and code_points(key) >= min_chars:
                        rows.append((digest(key.lower()), d, k, pos))
                        if len(rows) >= ROWS_OUT:
                            yield _lines(rows)
                            rows = []
        if rows:
            yield _lines(rows)

    def _lines(rows: list[tuple]) -> pa.RecordBatch:
        hashes, d, k, pos = zip(*rows)
        both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(d, pa.int64()), pa.array(k, pa.int64()),
             pa.array(pos, pa.int32())], ["h1", "h2", "d", "k", "pos"])

    return docs.select(*_identity(docs), F.col("text")).mapInArrow(run, LINES)


def first_occurrences(lines: DataFrame) -> DataFrame:
    """Rows to drop (kind DROP), rows of the first hash of a task (OPEN) and
    the first document of the first and last hash of each task (EDGE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int] | None = None  # hash and keeper of the hash being read
        in_first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, d, k, pos = (batch.column(i).to_numpy() for i in range(5))
            new = np.ones(len(h1), dtype=bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new[0] = last is None or (h1[0], h2[0]) != last[:2]
            if last is None:
                yield _rows(EDGE, h1[:1], h2[:1], d[:1], k[:1], pos[:1])
            group = np.cumsum(new)  # 0: the hash that the last batch ended with
            keepers = np.concatenate([[last[2] if last else 0], d[new]])[group]
            ends = group == (1 if last is None else 0)
            open_ = ends if in_first else np.zeros(len(h1), dtype=bool)
            in_first = in_first and bool(ends.all())
            drop = ~open_ & (d != keepers)
            for kind, mask in ((OPEN, open_), (DROP, drop)):
                if mask.any():
                    yield _rows(kind, h1[mask], h2[mask], d[mask], k[mask], pos[mask])
            last = (h1[-1], h2[-1], keepers[-1])
        if last is not None:
            one = [np.array([x], dtype=np.int64) for x in last]
            yield _rows(EDGE, *one, np.zeros(1, np.int64), np.zeros(1, np.int32))

    def _rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(columns[0]), kind, dtype=np.int32))
        return pa.RecordBatch.from_arrays([kinds, *map(pa.array, columns)], ["kind", "h1", "h2", "d", "k", "pos"])

    keys = ["h1", "h2", "d", "k", "pos"]
    return (lines.repartitionByRange(*map(F.col, keys)).sortWithinPartitions(*keys)
            .mapInArrow(run, "kind int, " + LINES))


@F.arrow_udf(T.BinaryType())
def _bitmap(positions: pa.Array) -> pa.Array:
    """Keep bits, lowest first, in bytes up to that of the last dropped line."""
    out = []
    for p in positions:
        dropped = p.values.to_numpy()
        keep = np.ones(int(dropped.max()) // 8 * 8 + 8, dtype=np.uint8)
        keep[dropped] = 0
        out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
    return pa.array(out, pa.binary())


@F.arrow_udf(T.StringType())
def _kept(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    out = []
    for t, b in zip(text, bitmap):
        if not t.is_valid or not b.is_valid:
            out.append(None)
            continue
        keep = np.unpackbits(np.frombuffer(zlib.decompress(b.as_py()), np.uint8), bitorder="little")
        lines = t.as_py().split("\n")
        out.append("\n".join([x for i, x in enumerate(lines) if i >= len(keep) or keep[i]]))
    return pa.array(out, pa.string())


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row per document that loses lines: ``d, k`` (id, null as the
    largest long, and hash of the text), ``n_dropped``, ``keep`` (a
    compressed bitmap; lines after its last bit stay).

    A line is matched by its key: stripped of ASCII white space, A-Z lowered.
    A key of ``min_chars`` code points or more that two or more documents
    hold keeps its lines in the smallest doc_id only (all of them there).
    Null or empty text is one empty line.  Rows with equal doc_id are one
    document; null doc_ids are one document that comes last.  Other columns
    are ignored.  An empty table gives no bitmaps.
    """
    if min_chars < 1:
        raise ValueError("min_chars is 1 at least")
    lines = written(line_hashes(docs, min_chars), "line-hashes")
    found = written(first_occurrences(lines), "line-firsts")
    # At most two rows for each shuffle partition.
    keepers = F.broadcast(found.filter(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("d").alias("keeper")))
    opened = (found.filter(F.col("kind") == OPEN).join(keepers, ["h1", "h2"])
              .filter(F.col("d") != F.col("keeper")).select("d", "k", "pos"))
    dropped = found.filter(F.col("kind") == DROP).select("d", "k", "pos").unionByName(opened)
    return (dropped.groupBy("d", "k").agg(F.collect_set("pos").alias("p"))
            .select("d", "k", F.size("p").alias("n_dropped"), _bitmap("p").alias("keep")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_lines``, ``n_dropped`` and
    ``kept`` (the text without the dropped lines; null text as empty)."""
    rows = docs.select(packed(docs), *_identity(docs))
    joined = rows.join(bitmaps.hint("shuffle_hash"), ["d", "k"], "left")
    text = F.coalesce(F.col("row.text"), F.lit(""))
    lost = F.col("keep").isNotNull()
    return joined.select(
        "row",
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(lost, _kept(F.when(lost, text), F.col("keep"))).otherwise(text).alias("kept"))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs``, all rows and columns, with repeated lines taken out of
    ``text`` (see :func:`keep_bitmaps` for which); ``n_chars``, where there is
    one, follows the new text.  Documents that lose nothing are unchanged,
    null texts stay null, and a document that loses every line has an empty
    text."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
    new = {c: F.col("row").getField(c) for c in docs.columns}
    changed = F.col("n_dropped") > 0
    new["text"] = F.when(changed, F.col("kept")).otherwise(new["text"])
    if "n_chars" in new:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(new["n_chars"])
    return out.select(*[value.alias(c) for c, value in new.items()])
