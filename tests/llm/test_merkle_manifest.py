import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from obslake.llm import merkle_manifest
from obslake.llm.queries import op13_merkle_manifest

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows, fanout, claimed=lambda row: row):
    """(doc_id, leaf, subroot, root, proof, folded, verified) per row."""
    def grow(level):
        levels = [level]
        while len(levels[-1]) > 1:
            runs = [levels[-1][i:i + fanout] for i in range(0, len(levels[-1]), fanout)]
            levels.append([h("".join(r)) for r in runs])
        return levels

    def siblings(levels, at):
        out = []
        for level in levels[:-1]:
            first = at - at % fanout
            out.append((level[first:at], level[at + 1:first + fanout]))
            at //= fanout
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (mine, grow([leaf_of(r) for r in mine]))
    over = grow([trees[s][1][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        mine, levels = trees[s]
        for at, row in enumerate(mine):
            path = siblings(levels, at) + siblings(over, i)
            folded = leaf_of(claimed(row))
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join("".join(a + b) for a, b in path))
            out.append((row[0], levels[0][at], levels[-1][0], over[-1][0], proof, folded, folded == over[-1][0]))
    return sorted(out, key=repr)


ROWS = [(i, f"s{i % 3}" if i % 11 else None, "en", i * 2, f"Text {i}") for i in range(90)]
ODD = [(5, "s1", "en", 1, "same id, other text"), (5, "s1", "en", 1, "same id, other text"), (None, "s2", None, None, None),
       (7, "", "fr", 0, ""), (8, "école", None, 3, "ÀB\n" * 50_000), (-4, "S", "de", 2, "A"), (9, "0", "x", 1, "Q"),
       (10, "😀", "x", 1, "Q"), (11, "￮", "x", 1, "Q")]


def lowered(row):
    hit = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]) if hit else row[4]
    return (*row[:4], text)


@pytest.mark.parametrize("fanout", [2, 16])
def test_every_column_equals_brute_force(spark, fanout):
    rows = ROWS + ODD
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(hit, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    found = merkle_manifest.build(docs, fanout, text).verified().collect()
    want = brute(rows, fanout, lowered)
    assert sorted(map(tuple, found), key=repr) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 16, 257])
def test_sizes_around_the_fanout(spark, n):
    rows = [(i, "a", None, None, str(i)) for i in range(n)]
    manifest = merkle_manifest.build(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, manifest.verified().collect()), key=repr) == brute(rows, 16)
    assert (manifest.root is None) == (n == 0)


def test_many_sources_of_one_document(spark):
    rows = [(i, f"host{i:03d}", "en", 1, "x") for i in range(40)]
    manifest = merkle_manifest.build(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, manifest.verified().collect()), key=repr) == brute(rows, 16)
    nodes = manifest.nodes().collect()
    assert sum(r["level"] == 0 for r in nodes) == 40 and sum(r["level"] == -1 for r in nodes) == 3
    assert [r["digest"] for r in nodes if r["level"] == -2] == [manifest.root]


def test_clashing_columns_are_ignored(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    more = docs.withColumns({c: F.lit("?") for c in ("tree", "n", "at", "leaf", "claimed", "row", "part", "named", "tie")})
    assert merkle_manifest.build(more).root == merkle_manifest.build(docs).root


def test_a_change_of_any_field_changes_the_root(spark):
    base = merkle_manifest.build(spark.createDataFrame(ROWS, DOCS)).root
    for column, value in ((1, "s9"), (2, None)):
        changed = [tuple(value if i == column and row[0] == 50 else v for i, v in enumerate(row)) for row in ROWS]
        assert merkle_manifest.build(spark.createDataFrame(changed, DOCS)).root != base


def test_query_has_one_row_a_document(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r[c] for c in merkle_manifest.FIELDS) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    found = op13_merkle_manifest(spark, sf)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 16, lowered)


def test_levels_join_on_computed_indices_without_python(spark):
    nodes = spark.createDataFrame([(0, 40, i, h(str(i))) for i in range(40)], "tree bigint, n bigint, at bigint, digest string")
    plan = merkle_manifest.level_up(nodes, 16)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
