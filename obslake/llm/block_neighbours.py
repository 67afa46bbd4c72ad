"""Nearest neighbours by a block matrix join with int8 product tiles.

A vector x is stored as int8 codes q and a scale s, with the norm of what the
codes miss, e = |x - s q|.  The product of a block of queries with a block of
candidates is a matrix product of the codes; with the scales it gives the
distance of the two approximations, and by the triangle inequality the true
distance lies within the two misses of it.  A candidate whose lower bound is
over the k-th smallest upper bound (or the k-th distance found so far) cannot
be among the k nearest; the others are recomputed in double precision from the
vectors as they are, and kept in a heap of k for each query.  The result is
exact: nothing is left out that the bounds do not exclude.

Candidates are dealt out into parts of about ``part_rows``.  A part is loaded
once by one task, and the queries stream past it, batch by batch; every query
goes to every part, which is the stated query set against all rows in blocks.
Each part gives k rows a query at most, and these are ranked together.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import written

PART_ROWS = 65_536
TILE_ROWS = 8_192  # candidates of a tile
QUERY_ROWS = 256  # queries of a tile
FOUND = "query_row bigint, query_id bigint, vec_id bigint, score double"
CODED = "id bigint, vector array<float>, codes binary, scale double, missed double"


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id, vector, codes, scale, missed`` of the vectors that take part."""
    kept = vectors.select(F.col(id_column).cast("bigint").alias("id"),
                          F.col(vector_column).cast("array<float>").alias("vector")).filter(
        F.col("id").isNotNull() & usable(F.col("vector")))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scales, missed = [], [], []
            for vector in batch.column(1):
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                # a scale of normal size, so that code times scale is the approximation
                s = max(float(np.abs(x).max()) / 127, float(np.finfo(np.float64).tiny))
                q = np.clip(np.rint(x / s), -127, 127)
                codes.append(q.astype(np.int8).tobytes())
                scales.append(s)
                missed.append(float(np.sqrt(((x - s * q) ** 2).sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.binary()), pa.array(scales, pa.float64()),
                 pa.array(missed, pa.float64())], ["id", "vector", "codes", "scale", "missed"])

    return kept.mapInArrow(code, CODED)


class Block:
    """Vectors of one dimension: codes as a matrix, scales, misses, norms."""

    def __init__(self, rows: pa.Table | pa.RecordBatch):
        self.ids = rows.column("id").to_numpy()
        listed = rows.column("vector")
        listed = listed.combine_chunks() if isinstance(listed, pa.ChunkedArray) else listed
        n = len(self.ids)
        self.vectors = listed.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        dim = self.vectors.shape[1]
        # Products of int8 codes are whole numbers: float32 holds their sums
        # exactly up to 2^24, float64 up to 2^53.
        self.kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
        self.codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), dtype=np.int8).reshape(n, dim)
        self.scales = rows.column("scale").to_numpy()
        self.missed = rows.column("missed").to_numpy()
        whole = self.codes.astype(np.int64)
        self.norms = (whole * whole).sum(axis=1) * self.scales ** 2

    def tile(self, other: Block, mine: slice, its: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the distances of two slices."""
        product = self.codes[mine].astype(self.kind) @ other.codes[its].astype(self.kind).T
        cross = product.astype(np.float64) * self.scales[mine, None] * other.scales[None, its]
        total = self.norms[mine, None] + other.norms[None, its]
        near = np.sqrt(np.maximum(total - 2 * cross, 0))
        # rounding of the sums: the squared distance is off by a few ulps of
        # the norms, so the distance by the square root of that at most
        slack = self.missed[mine, None] + other.missed[None, its] + np.sqrt(total * 1e-14)
        return near - slack, near + slack


def distances(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in order."""
    off = others.astype(np.float64) - query.astype(np.float64)
    return np.sqrt(np.cumsum(off * off, axis=1)[:, -1])


def nearest(queries: Block, part: Block, k: int) -> list[list[tuple[float, int]]]:
    """For each query the (distance, id) of its k nearest of a part, in
    order; rows with the query's own id are passed over."""
    out = []
    for first in range(0, len(queries.ids), QUERY_ROWS):
        mine = slice(first, min(first + QUERY_ROWS, len(queries.ids)))
        heaps: list[list[tuple[float, int]]] = [[] for _ in range(mine.stop - first)]
        for begin in range(0, len(part.ids), TILE_ROWS):
            its = slice(begin, begin + TILE_ROWS)
            ids = part.ids[its]
            lower, upper = queries.tile(part, mine, its)
            own = queries.ids[mine, None] == ids[None, :]
            upper[own], lower[own] = np.inf, np.inf
            if upper.shape[1] > k:
                limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
            else:
                limit = np.full(len(heaps), np.inf)
            kth = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
            close = (lower <= np.minimum(limit, kth)[:, None]) & ~own
            for row in np.flatnonzero(close.any(axis=1)):
                at, heap = np.flatnonzero(close[row]), heaps[row]
                exact = distances(queries.vectors[first + row], part.vectors[its][at])
                # heaps hold the worst on top: the largest (distance, id)
                for d, i in zip(exact.tolist(), ids[at].tolist()):
                    if len(heap) < k:
                        heapq.heappush(heap, (-d, -i))
                    elif (-d, -i) > heap[0]:
                        heapq.heapreplace(heap, (-d, -i))
        out += [sorted((-d, -i) for d, i in h) for h in heaps]
    return out


def top_k(coded: DataFrame, queries: DataFrame, k: int, part_rows: int = PART_ROWS) -> DataFrame:
    """The k nearest rows of ``coded`` (:func:`quantised`) for every row of
    ``queries`` (the same columns): ``query_id, rank, id, score``.

    Rank is from 1, ties go to the smaller id; fewer candidates than k give
    fewer rows.  Rows with the query's own id are no candidates.  A candidate
    row that repeats another counts as a row; a query row that repeats an id
    has a list of its own.  Vectors are compared with those of their own
    dimension; rows without an id take no part.  No queries or no candidates: no
    rows.
    """
    if k < 1:
        raise ValueError("k is 1 or more")
    size = F.size("vector")
    sizes = coded.groupBy(size.alias("dim")).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts"))
    sizes = written(sizes, "sizes")
    # A row's place, not its id, says where it goes: an id that repeats is
    # spread like any other.
    numbered = coded.withColumns({"row": F.monotonically_increasing_id(), "dim": size}).join(sizes, "dim")
    columns = ["dim", "part", "query_row", "id", "vector", "codes", "scale", "missed"]
    candidates = numbered.withColumns({
        "part": F.pmod(F.xxhash64("row"), "parts").cast("int"), "query_row": F.lit(None).cast("bigint")}).select(*columns)
    asked = queries.withColumns({"query_row": F.monotonically_increasing_id(), "dim": size}).join(sizes, "dim").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*columns)
    parts = sizes.agg(F.sum("parts")).first()[0] or 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: list[pa.RecordBatch] = []
        key, block = None, None
        for batch in batches:
            keys = batch.column("dim").to_numpy().astype(np.int64) << 32 | batch.column("part").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                run = batch.slice(begin, end - begin)
                if key != keys[begin]:
                    key, block, loaded = keys[begin], None, []
                n = run.column("query_row").null_count  # candidates come first
                if n:
                    loaded.append(run.slice(0, n))
                if n == run.num_rows:
                    continue
                if block is None and loaded:
                    block, loaded = Block(pa.Table.from_batches(loaded)), []
                if block is None:
                    continue
                asking = run.slice(n)
                found = nearest(Block(asking), block, k)
                count = np.array([len(f) for f in found])
                flat = [x for f in found for x in f]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(asking.column("query_row").to_numpy(), count)),
                    pa.array(np.repeat(asking.column("id").to_numpy(), count)),
                    pa.array([i for _, i in flat], pa.int64()), pa.array([d for d, _ in flat], pa.float64())],
                    ["query_row", "query_id", "vec_id", "score"])

    dealt = candidates.unionByName(asked).repartition(parts, "dim", "part").sortWithinPartitions(
        "dim", "part", F.col("query_row").asc_nulls_first())
    found = dealt.mapInArrow(search, FOUND)
    best = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("vec_id").alias("id"), "score")
