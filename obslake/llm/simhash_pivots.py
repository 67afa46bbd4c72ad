"""Near-duplicates by SimHash, linked through pivot distance tables.

Each fingerprint gets a row of a pivot table: its Hamming distances to many
reference fingerprints, computed once and carried with it to its blocks, eight
to a long.  By the triangle inequality two
fingerprints within ``max_bits`` differ by at most that in every coordinate,
so a pair with a larger maximum coordinate difference is discarded; only
survivors have their own distance computed.

To meet partners without looking at all pairs, some references are a base
and the base with one bit flipped.  How such a coordinate differs from the
base's tells that bit, so the coordinates of a segment of the bits are equal
for two fingerprints exactly if they agree there.  With ``max_bits + 3``
segments, two linked fingerprints agree on three of them at least: blocks
are the coordinates of any three segments (20 blocks of about 32 bits per
fingerprint for three bits).  Inside a block the maximum coordinate
difference runs over the other references, which are random.

Equal fingerprints are one class from the start.  A block gives a spanning
forest of its links, not all its pairs.  A block of more than ``block_rows``
classes is cut into chunks and all pairs of chunks are dealt to tasks, so no
task holds more than two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import packed, utf8, word_blocks, written
from obslake.llm.components import components

SEED = 42
BITS = 64
HASHES_AT_ONCE = 1 << 15  # 2 MB of bits
RANDOM_REFERENCES = 24
BLOCK_ROWS = 8_192
FREE_SEGMENTS = 3  # segments in a block's key
TABLE = [f"p{i}" for i in range(RANDOM_REFERENCES // 8)]  # columns of the pivot table
TABLE_DDL = ", ".join(f"{c} bigint" for c in TABLE)


def fingerprint(text: bytes, shingle: int) -> int:
    """Bit i is set if it is in over half the hashes of the shingles."""
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    words: list[bytes] = []
    n = 0
    for block in word_blocks(text.lower()):
        words += block  # after the last words of the block before
        here = len(words) - shingle + 1
        if here < 1:
            continue
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) + 1 for w in words], out=starts[1:])
        begins, ends = starts[:here].tolist(), (starts[shingle:] - 1).tolist()
        joined = b" ".join(words)
        for lo in range(0, here, HASHES_AT_ONCE):
            spans = zip(begins[lo:lo + HASHES_AT_ONCE], ends[lo:lo + HASHES_AT_ONCE])
            h = np.array([hashed(joined[i:j], SEED) for i, j in spans], dtype="<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        n += here
        words = words[here:]
    if not n:
        return hashed(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's 64 bits as a signed long)."""

    @F.arrow_udf("bigint")
    def fp(text: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t, shingle) for t in utf8(text)), dtype="<u8", count=len(text))
        return pa.array(values.view("<i8"))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), fp(F.col("text")).alias("fp"))


class PivotTable:
    """References and the distances of fingerprints to them."""

    def __init__(self, max_bits: int):
        rng = np.random.default_rng(SEED)
        self.base = rng.integers(0, 2**64, 1, dtype=np.uint64)
        self.flips = self.base ^ (np.uint64(1) << np.arange(BITS, dtype=np.uint64))
        self.others = rng.integers(0, 2**64, RANDOM_REFERENCES, dtype=np.uint64)
        self.max_bits = max_bits
        segments = np.array_split(np.arange(BITS), max_bits + FREE_SEGMENTS)
        self.blocks = [np.concatenate(c) for c in combinations(segments, FREE_SEGMENTS)]

    @staticmethod
    def distances(fps: np.ndarray, references: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)

    def coordinates(self, fps: np.ndarray) -> np.ndarray:
        """Distances to the random references, eight to a long: a row for each
        column of TABLE."""
        return np.ascontiguousarray(self.distances(fps, self.others).view(np.int64).T)

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """Block keys (n, blocks): the flips' coordinates against the base's,
        one bit each, below the number of the block."""
        above = self.distances(fps, self.flips) > self.distances(fps, self.base)
        out = np.empty((len(fps), len(self.blocks)), dtype=np.int64)
        for j, bits in enumerate(self.blocks):
            weights = np.int64(1) << np.arange(len(bits), dtype=np.int64)
            out[:, j] = (np.int64(j) << np.int64(len(bits))) + above[:, bits] @ weights
        return out


def block_keys(classes: DataFrame, max_bits: int) -> DataFrame:
    """``key, fp`` and the row of the pivot table, for each block of each
    class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = PivotTable(max_bits)
        for batch in batches:
            for part in (batch.slice(lo, 4_096) for lo in range(0, batch.num_rows, 4_096)):
                fps = part.column(0).to_numpy().view(np.uint64)
                keys = pivots.keys(fps)
                per_block = [np.repeat(c, keys.shape[1]) for c in (fps.view(np.int64), *pivots.coordinates(fps))]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *map(pa.array, per_block)], ["key", "fp", *TABLE])

    return classes.select("fp").mapInArrow(run, f"key bigint, fp bigint, {TABLE_DDL}")


def _forest(key: np.ndarray, side: np.ndarray, fps: np.ndarray, table: np.ndarray,
            max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member) links inside each block of a sorted run of
    rows, with their rows of the pivot table.  ``side``: -1 pairs all rows of a
    block, 0 and 1 only pair across."""
    n = len(fps)
    root = np.arange(n)
    alive = np.arange(n - 1) if n else np.arange(0)
    lag = 0
    while True:
        lag += 1
        alive = alive[alive + lag < n]
        alive = alive[key[alive] == key[alive + lag]]
        if not len(alive):
            break
        for lo in range(0, len(alive), 1 << 16):
            a = alive[lo:lo + (1 << 16)]
            b = a + lag
            apart = (root[a] != root[b]) & ((side[a] < 0) | (side[a] != side[b]))
            a, b = a[apart], b[apart]
            near = (np.abs(table[a] - table[b]) <= max_bits).all(axis=1)  # else the pivots tell them apart
            a, b = a[near], b[near]
            near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
            for i, j in zip(a[near].tolist(), b[near].tolist()):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                while root[j] != j:
                    root[j] = root[root[j]]
                    j = root[j]
                if i != j:
                    root[max(i, j)] = min(i, j)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    linked = np.flatnonzero(root != np.arange(n))
    return fps[linked], fps[root[linked]]


PAIRS = f"kind int, a bigint, b bigint, chunk int, {TABLE_DDL}"
LINK, SPLIT = 0, 1


def _links(rows: DataFrame, max_bits: int, block_rows: int, split: bool) -> DataFrame:
    """Streams rows (key, side, fp, pivot table) sorted by block: links of the
    blocks (LINK: a, b) and, with ``split``, the rows of blocks that are too
    large, by chunk (SPLIT: key, fp, chunk, pivot table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3 + len(TABLE), 0), dtype=np.int64)  # key, side, fp, pivot table
        split_key: int | None = None  # the block being cut, and its next chunk
        chunk = 0

        def out(kind: int, a: np.ndarray, b: np.ndarray, number: int, table: np.ndarray | None = None) -> pa.RecordBatch:
            carried = [pa.nulls(len(a), pa.int64())] * len(TABLE) if table is None else map(pa.array, table)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.array(np.full(len(a), number, np.int32)), *carried], ["kind", "a", "b", "chunk", *TABLE])

        def linked(part: np.ndarray) -> Iterator[pa.RecordBatch]:
            same = part[0][1:] == part[0][:-1]
            rows_of = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False)) if same.any() else []
            if len(rows_of):
                part = part[:, rows_of]
                table = np.ascontiguousarray(part[3:].T).view(np.int8)
                a, b = _forest(part[0], part[1], part[2].view(np.uint64), table, max_bits)
                if len(a):
                    yield out(LINK, a, b, 0)

        def work(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, split_key, chunk
            if not held.shape[1]:
                return
            final_key = held[0, -1]
            if split_key is not None and held[0, 0] == split_key:  # the rest of a block being cut
                m = int(np.searchsorted(held[0] != split_key, True)) if final_key != split_key else held.shape[1]
                yield out(SPLIT, held[0, :m], held[2, :m], chunk, held[3:, :m])
                chunk += 1
                held = held[:, m:]
                if not held.shape[1]:
                    return
            split_key = None
            cut = held.shape[1] if last else int(np.argmax(held[0] == final_key))
            if cut:
                yield from linked(held[:, :cut])
                held = held[:, cut:]
            elif split and held.shape[1] >= block_rows:  # one block, and it goes on
                split_key, chunk = int(final_key), 1
                yield out(SPLIT, held[0], held[2], 0, held[3:])
                held = held[:, :0]

        for batch in batches:
            columns = [c.to_numpy().astype(np.int64) for c in batch.columns]
            for lo in range(0, batch.num_rows, block_rows):
                held = np.concatenate([held, np.stack([c[lo:lo + block_rows] for c in columns])], axis=1)
                if held.shape[1] >= block_rows:
                    yield from work(last=False)
        yield from work(last=True)

    return rows.select("key", "side", "fp", *TABLE).mapInArrow(run, PAIRS)


def links(classes: DataFrame, max_bits: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges ``a, b`` between fingerprints of ``classes`` (column fp,
    distinct) whose components are those of all pairs within ``max_bits``."""
    keyed = block_keys(classes, max_bits).withColumn("side", F.lit(-1).cast("bigint"))
    rows = keyed.repartition("key").sortWithinPartitions("key", "fp")
    first = written(_links(rows, max_bits, block_rows, split=True), "simhash-links")
    # Chunks of blocks that were too large: every pair of chunks is a block of
    # its own (a pair of a chunk with itself pairs all its rows).
    cut = first.filter(F.col("kind") == SPLIT).select(F.col("a").alias("key"), F.col("b").alias("fp"), "chunk", *TABLE)
    chunks = cut.groupBy("key").agg((F.max("chunk") + 1).alias("n"))
    pairs = cut.join(chunks, "key").select(
        "key", "fp", "chunk", *TABLE, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    i, j = F.least("chunk", "other"), F.greatest("chunk", "other")
    rows = (pairs.select(F.xxhash64("key", i, j).alias("key"), "fp", *TABLE,
                         F.when(i == j, -1).otherwise((F.col("chunk") == j).cast("int")).cast("bigint").alias("side"))
            .repartition("key").sortWithinPartitions("key", "fp"))
    second = _links(rows, max_bits, block_rows, split=False)
    both = first.filter(F.col("kind") == LINK).unionByName(second.filter(F.col("kind") == LINK))
    return both.select("a", "b")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits.

    Texts without a word, null ones too, have fingerprint zero and link like
    any other.  Rows that repeat a doc_id give a row each.  A row with a null
    doc_id links like others, its component_id is the smallest id there is in
    its component (null if there is none).  Other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes", narrow=True)
    roots = components(links(classes, max_bits, block_rows))
    named = classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = written(named.join(least, "root").select("fp", "component_id"), "simhash-labels", narrow=True)
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest
    doc_id.  Rows that repeat this id are the same document and all stay; a
    row with a null id cannot be named by a component and stays."""
    found = simhash_components(docs, shingle, max_bits)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    rows = docs.select(packed(docs), F.col("doc_id").cast("bigint").alias("id"))
    named = rows.join(kept.select(F.col("doc_id").alias("id")).hint("shuffle_hash"), "id", "left_semi")
    return named.select("row.*").unionByName(docs.filter("doc_id IS NULL"))
