"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's bits are cut into segments of 16; the index sorts the codes by each
segment's value.  A query looks up all values at radius 0 of its first
segment, then of the second, and so on, then at radius 1, 2, ...  Once the
first a+1 segments of m have been searched up to radius r and the others up
to r-1, every code within m*r + a bits has been met (pigeonhole), so the
search ends as soon as the k-th verified distance is at most that.

The index is dealt out by hash into parts of about ``part_rows`` codes.  A part
is loaded and indexed once by one task, and the queries stream past it in
blocks; each part gives its k nearest for each query, and these are merged.
Index rows are moved once, queries once for each part.  Nothing of unbounded
size is broadcast, and a task holds one part of the index and one block of
queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEGMENT = 16
PART_ROWS = 1 << 20  # codes of 64 bits: about 60 MB with their index
QUERY_BLOCK = 4_096


def sign_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id, code``: one bit per element, set where it is above zero (null
    and NaN are not), lowest first, in 16-bit segments.  Null vectors have a
    null code, empty ones an empty code."""

    @F.arrow_udf("binary")
    def code(values: pa.Array) -> pa.Array:
        out = []
        for v in values:
            if not v.is_valid:
                out.append(None)
                continue
            bits = np.array([x is not None and x > 0 for x in v.as_py()], dtype=bool)
            bits = np.append(bits, np.zeros(-len(bits) % SEGMENT, dtype=bool))
            out.append(np.packbits(bits, bitorder="little").tobytes())
        return pa.array(out, pa.binary())

    return vectors.select(F.col(id_column).cast("bigint").alias("id"), code(F.col(vector_column)).alias("code"))


_MASKS: dict[int, np.ndarray] = {}


def masks(radius: int) -> np.ndarray:
    """All 16-bit masks with ``radius`` bits."""
    if radius not in _MASKS:
        _MASKS[radius] = np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), radius)], np.int64)
    return _MASKS[radius]


class MultiIndex:
    """Codes as (n, m) unsigned 16-bit segments, with their ids."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[order], codes[order]
        self.n, self.m = codes.shape
        self.rows = [np.argsort(self.codes[:, s], kind="stable") for s in range(self.m)]
        counts = [np.bincount(self.codes[:, s], minlength=1 << SEGMENT) for s in range(self.m)]
        self.ends = [np.cumsum(c) for c in counts]

    def _at(self, s: int, values: np.ndarray) -> np.ndarray:
        """Rows whose segment ``s`` has one of the values."""
        ends = self.ends[s][values]
        starts = np.where(values > 0, self.ends[s][values - 1], 0)
        lengths = ends - starts
        total = int(lengths.sum())
        if not total:
            return np.zeros(0, dtype=np.int64)
        within = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return self.rows[s][np.repeat(starts, lengths) + within]

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest, ties by id."""
        if not self.m:
            rows = np.arange(min(k, self.n))
            return self.ids[rows], np.zeros(len(rows), dtype=np.int64)
        met = np.zeros(self.n, dtype=bool)
        rows, distances = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for radius in range(SEGMENT + 1):
            for s in range(self.m):
                new = self._at(s, masks(radius) ^ int(query[s]))
                new = new[~met[new]]
                met[new] = True
                d = np.bitwise_count(self.codes[new] ^ query).sum(axis=1, dtype=np.int64)
                rows, distances = np.concatenate([rows, new]), np.concatenate([distances, d])
                # Rows are ordered by id, so ties fall to the smaller id.
                best = np.lexsort((rows, distances))[:k]
                rows, distances = rows[best], distances[best]
                if len(rows) == k and distances[-1] <= self.m * radius + s:
                    return self.ids[rows], distances
        return self.ids[rows], distances


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, part_rows: int = PART_ROWS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank`` (from 1), ``id, distance``: for every query the
    ``k`` rows of ``index`` with the smallest Hamming distance, ties by
    smallest id; fewer if the index has fewer.  Both tables have ``id, code``
    (see :func:`sign_codes`).

    Rows with a null id or code are left out on both sides, and only codes of
    one length are compared.  An id that repeats is several rows of the index,
    and one query that takes the k best of all its codes.  A query that is in
    the index finds itself.
    """
    index = index.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code")
    queries = queries.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    n_parts = max(1, -(-index.count() // part_rows))
    rows = index.withColumns({"part": F.pmod(F.xxhash64("id", "code"), F.lit(n_parts)).cast("int"), "asks": F.lit(False)})
    asked = queries.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))), "asks": F.lit(True)})

    def found(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())],
            names=["query_id", "id", "distance"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        held: dict[int, tuple[list, list]] = {}  # ids and codes by bytes of a code
        built: dict[int, MultiIndex] = {}
        out: list[tuple[int, int, int]] = []
        for batch in batches:
            for i, c, p, asks in zip(*[column.to_pylist() for column in batch.columns]):
                if p != part:
                    part, held, built = p, {}, {}
                if not asks:  # the codes of a part come before its queries
                    ids, codes = held.setdefault(len(c), ([], []))
                    ids.append(i)
                    codes.append(c)
                    continue
                if len(c) not in built:
                    if len(c) not in held:
                        continue
                    ids, codes = held.pop(len(c))
                    built[len(c)] = MultiIndex(np.array(ids, dtype=np.int64),
                                               np.frombuffer(b"".join(codes), "<u2").reshape(len(codes), len(c) // 2))
                near, distances = built[len(c)].nearest(np.frombuffer(c, "<u2"), k)
                out += [(i, int(a), int(d)) for a, d in zip(near, distances)]
                if len(out) >= query_block * k:
                    yield found(out)
                    out = []
        if out:
            yield found(out)

    dealt = rows.unionByName(asked).repartition(n_parts, "part").sortWithinPartitions("part", "asks")
    nearest = dealt.mapInArrow(search, "query_id bigint, id bigint, distance int")
    # At most k rows of each part and query are left to merge.
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return (nearest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "distance"))
