import numpy as np
import pytest

from obslake.llm import hamming_search as hs


def brute(index, queries, k):
    """(query, id, distance) rows of lists of (id, code int)."""
    out = []
    for q, c in queries:
        near = sorted(((c ^ d).bit_count(), i) for i, d in index)[:k]
        out += [(q, rank, i, dist) for rank, (dist, i) in enumerate(near, 1)]
    return out


def to_bytes(code, bits=64):
    return code.to_bytes(bits // 8, "little")


@pytest.mark.parametrize("part_rows, query_block", [(hs.PART_ROWS, hs.QUERY_BLOCK), (100, 7)])
def test_equals_brute_force(spark, part_rows, query_block):
    rng = np.random.default_rng(3)
    codes = [int(x) for x in rng.integers(0, 2**64, 500, dtype=np.uint64)]
    codes += [codes[0]] * 200 + [codes[1] ^ (1 << i) for i in range(64)]  # copies, and ties all around one code
    rows = list(enumerate(codes))
    df = spark.createDataFrame([(i, bytearray(to_bytes(c)), "x", 1) for i, c in rows], "id bigint, code binary, part string, `rank` int")
    for k in (1, 10):
        got = hs.top_k(df, df.filter("id % 25 = 0"), k, part_rows, query_block).collect()
        assert sorted(map(tuple, got)) == sorted(brute(rows, [r for r in rows if r[0] % 25 == 0], k))


def test_a_part_is_indexed_once(spark):
    """No row of the index is copied: only the queries go to every part."""
    rng = np.random.default_rng(4)
    rows = [(i, bytearray(to_bytes(int(x)))) for i, x in enumerate(rng.integers(0, 2**64, 300, dtype=np.uint64))]
    df = spark.createDataFrame(rows, "id bigint, code binary")
    plan = hs.top_k(df, df.filter("id < 90"), 3, part_rows=60)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("MapInArrow") == 1 and "Join" not in plan


def test_search_stops_when_covered():
    rng = np.random.default_rng(1)
    index = hs.MultiIndex(np.arange(3_000), rng.integers(0, 1 << 16, (3_000, 4)).astype(np.uint16))
    looked = []
    at = index._at
    index._at = lambda s, values: looked.append(len(values)) or at(s, values)
    ids, distances = index.nearest(index.codes[17], 1)
    assert ids.tolist() == [17] and distances.tolist() == [0] and looked == [1]


def test_edges(spark):
    rows = [(1, [0.5, -1.0, None, 2.0]), (2, None), (None, [1.0]), (3, [0.0, float("nan")]), (4, []), (5, [0.5, 0.0, 0.0, 2.0] * 9),
            (1, [0.5, -1.0, None, 2.0]), (1, [-0.5, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    codes = hs.sign_codes(df)
    found = {(r.id, bytes(r.code) if r.code is not None else None) for r in codes.collect()}
    assert (1, b"\x09\x00") in found and (2, None) in found and (3, b"\x00\x00") in found and (4, b"") in found
    got = sorted(map(tuple, hs.top_k(codes, codes, 2).collect()))
    assert [r for r in got if r[0] == 4] == [(4, 1, 4, 0)] and [r for r in got if r[0] == 5] == [(5, 1, 5, 0)]
    assert [r for r in got if r[0] == 3] == [(3, 1, 3, 0), (3, 2, 1, 1)]
    assert {r[0] for r in got} == {1, 3, 4, 5} and [r[1:] for r in got if r[0] == 1] == [(1, 1, 0), (2, 1, 0)]
    assert hs.top_k(codes.limit(0), codes, 2).collect() == [] and hs.top_k(codes, codes.limit(0), 2).collect() == []
