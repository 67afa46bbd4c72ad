import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import block_neighbours as bn
from obslake.llm.queries import op12_block_neighbours

VECTORS = "vec_id bigint, embedding array<float>"


def brute(rows, queries, k):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if ok(v)]
    out = []
    for q, v in rows:
        if queries(q):
            near = sorted((float(np.sqrt(np.cumsum((v - w) ** 2)[-1])), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return sorted(out)


def found(df, k, part_rows=bn.PART_ROWS, every=10):
    coded = bn.written(bn.quantised(df), "coded")
    return sorted(map(tuple, bn.top_k(coded, coded.filter(F.col("id") % every == 0), k, part_rows).collect()))


@pytest.mark.parametrize("dim,part_rows", [(1, 40), (7, 1000), (64, 64), (1200, 100)])
def test_equal_to_brute_force(spark, dim, part_rows):
    rng = np.random.default_rng(dim)
    scale = 10.0 ** rng.integers(-3, 4, size=(400, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.normal(size=(400, dim)) * scale)]
    df = spark.createDataFrame(rows, VECTORS)
    assert found(df, 10, part_rows) == brute(rows, lambda q: q % 10 == 0, 10)


def test_odd_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [0.0, 1.0]), (8, [0.0, -1.0]), (9, [2.0, 1.0]), (10, [3.0]), (11, [1.0, 0.0]), (12, [1.0, 0.0]),
            (20, [1e-30, 0.0]), (30, [1e30, 1e30]), (40, [5.0]), (50, [1e-44, 0.0])]
    df = spark.createDataFrame(rows, VECTORS)
    got = found(df, 3)
    assert got == brute(rows, lambda q: q % 10 == 0, 3)
    assert [r[2] for r in got if r[0] == 0][:2] == [11, 12]  # a tie goes to the smaller id
    assert [r[1:] for r in got if r[0] == 10] == [(1, 40, 2.0)]  # all candidates, if fewer


def test_many_copies_and_repeated_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300 + i, [float(i), 0.5, 1.0]) for i in range(40)]
    assert found(spark.createDataFrame(rows, VECTORS), 5, 50) == brute(rows, lambda q: q % 10 == 0, 5)
    twice = rows[:50] + [(7, [1.0, 2.0, 3.5]), (7, [1.0, 2.0, 3.5])]
    assert found(spark.createDataFrame(twice, VECTORS), 60, 20) == brute(twice, lambda q: q % 10 == 0, 60)


def test_no_rows_and_no_queries(spark):
    assert found(spark.createDataFrame([], VECTORS), 3) == []
    assert found(spark.createDataFrame([(1, [1.0]), (2, [2.0])], VECTORS), 3) == []
    assert found(spark.createDataFrame([(10, [1.0])], VECTORS), 3) == []


def test_bounds_hold_the_distance_and_exclude_most():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    def block(x):
        s = np.abs(x).max(axis=1) / 127
        q = np.rint(x / s[:, None])
        return bn.Block(pa.table({
            "id": np.arange(len(x)), "vector": list(x), "codes": [c.tobytes() for c in q.astype(np.int8)], "scale": s,
            "missed": np.sqrt(((x - q * s[:, None]) ** 2).sum(axis=1))}))

    x, y = rng.normal(size=(20, 64)), rng.normal(size=(3000, 64))
    y[:20] = x  # distance zero
    lower, upper = block(x).tile(block(y), slice(0, 20), slice(0, 3000))
    true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    assert (lower <= true).all() and (true <= upper).all()
    left = (lower <= np.sort(upper, axis=1)[:, 9:10]).sum() / lower.size
    assert left < 0.02


def test_query_and_clashing_columns(spark):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    got = op12_block_neighbours(spark, sf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda q: q % 100 == 0, 10)
    more = df.withColumns({c: F.lit("?") for c in ("id", "vector", "codes", "scale", "missed", "row", "dim", "part", "parts")})
    assert found(more, 2) == found(df, 2)
