import re

import numpy as np
import pytest
import xxhash

from obslake.llm import simhash_pivots as sp
from obslake.llm.common import FILES_A_CORE
from obslake.llm.components import components

EDGE_COLUMNS = "doc_id bigint, text string, fp string, root int, `a.b` int"


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_over_blocks(monkeypatch):
    from obslake.llm import common

    text = " ".join(f"Word{i % 97} {'x' * (i % 13)}" for i in range(900)).encode()
    whole = sp.fingerprint(text, 3)
    for size in (1, 20, 500):
        monkeypatch.setattr(sp, "word_blocks", lambda t, s=size: common.word_blocks(t, s))
        assert sp.fingerprint(text, 3) == whole
        assert [w for b in common.word_blocks(text, size) for w in b] == text.split()
    assert list(common.word_blocks(b" \t")) == [] and list(common.word_blocks(b"")) == []


def brute_components(prints, max_bits):
    """{position: smallest id reachable} of (id, fingerprint) pairs."""
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= max_bits:
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return {i: least.get(find(i)) for i in range(len(prints))}


@pytest.mark.parametrize("text", [
    None, "", " \t\n", "one", "One two", "a b c", "A b\x0bC d  e f É é", "x " * 70_000, "näh 😀 tea " * 9])
def test_fingerprint_equals_brute_force(text):
    assert sp.fingerprint((text or "").encode(), 3) == brute_fingerprint(text)


def test_documents_edges(spark):
    rows = [(5, "a b c d", "x", 1, 2), (3, "A  b\nc d", "y", 1, 2), (9, None, None, None, None), (8, "", "", 0, 0),
            (None, "a b c d", "", 0, 0), (None, "quite alone here", "", 0, 0), (5, "a b c d", "x", 1, 2)]
    df = spark.createDataFrame(rows, EDGE_COLUMNS)
    found = sp.simhash_components(df).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.fingerprint): r.component_id for r in found}
    same = f"{brute_fingerprint('a b c d'):016x}"
    assert got[(5, same)] == got[(3, same)] == got[(None, same)] == 3
    assert got[(9, "0" * 16)] == got[(8, "0" * 16)] == 8
    assert got[(None, f"{brute_fingerprint('quite alone here'):016x}")] is None
    kept = sp.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 3), (False, 8), (True, 0), (True, 0)]
    assert sp.simhash_components(df.limit(0)).collect() == [] and sp.one_of_each(df.limit(0)).collect() == []


@pytest.mark.parametrize("block_rows, max_bits", [(sp.BLOCK_ROWS, 3), (4, 3), (3, 2)])
def test_links_equal_brute_force(spark, block_rows, max_bits):
    """Chains, a dense cluster larger than a block's chunk, random ones."""
    rng = np.random.default_rng(7)
    base = [int(x) for x in rng.integers(0, 2**64, 60, dtype=np.uint64)]
    prints = list(base)
    for x in base[:6]:  # chains of close steps
        for _ in range(8):
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                x ^= 1 << int(b)
            prints.append(x)
    prints += [base[10] ^ (1 << int(b)) for b in range(40)]  # a dense cluster
    prints += [base[10] ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (40, 2))]
    prints = sorted(set(prints))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    found = components(sp.links(classes, max_bits, block_rows))
    roots = {r.node: r.root for r in found.collect()}
    least = brute_components(list(zip(signed, prints)), max_bits)
    ours = {}
    for x in signed:
        ours.setdefault(roots.get(x, x), set()).add(x)
    theirs = {}
    for i, x in enumerate(signed):
        theirs.setdefault(least[i], set()).add(x)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_pivot_coordinates_bound_the_distance():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**64, 300, dtype=np.uint64)
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    pivots = sp.PivotTable(3)
    gap = np.abs(pivots.distances(fps, pivots.others) - pivots.distances(near, pivots.others)).max(axis=1)
    assert (gap <= 1).all()
    far = np.abs(pivots.distances(fps[:150], pivots.others) - pivots.distances(fps[150:], pivots.others)).max(axis=1)
    assert (far > 3).mean() > 0.99
    keys = pivots.keys(fps)
    assert keys.shape == (300, 20) and (keys == pivots.keys(near)).sum(axis=1).min() >= 10


def test_components_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(path + hub + [(5, 5), (1, 0), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert len(found) == 501
    assert len({found[i] for i in range(301)}) == 1 and len({found[i] for i in range(1000, 1200)}) == 1
    assert found[0] != found[1000]


def test_registered_query_equals_brute_force(spark):
    from obslake.llm.queries import op1_simhash_pivots

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_simhash_pivots(spark, sf).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == {i: brute_fingerprint(t) for i, t in texts.items()}
    least = brute_components([(r.doc_id, int(r.fingerprint, 16)) for r in rows], 3)
    assert [r.component_id for r in rows] == [least[i] for i in range(len(rows))]


def test_components_write_a_few_files_a_core(spark):
    keys = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(4_000).selectExpr("id AS a", "id + 4000 AS b")
        found = components(edges)
        assert len(found.inputFiles()) <= FILES_A_CORE * spark.sparkContext.defaultParallelism < 200
        assert {(r.node, r.root) for r in found.collect()} == {(i, i % 4_000) for i in range(8_000)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
