import hashlib

import numpy as np
import pytest

from obslake.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id bigint, text string, n_chars bigint, k int, keep string, d int, `row` int"


def brute_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(docs, min_chars=10):
    """(n_lines, n_dropped, kept) of each (id, text), in order."""
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = brute_key(line)
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(float("inf") if doc is None else doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        me = float("inf") if doc is None else doc
        kept = [x for x in lines if not ((k := brute_key(x)) in holders and len(holders[k]) > 1 and min(holders[k]) != me)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(d, t, len(t or ""), 1, "x", 2, 3) for d, t in docs], SCHEMA)


def compare(spark, docs, min_chars=10):
    df = frame(spark, docs)
    rows = ld.apply_bitmaps(df, ld.keep_bitmaps(df, min_chars)).collect()
    key = lambda d, t, *rest: (d is None, d or 0, t or "", *rest)
    got = sorted(key(r.row.doc_id, r.row.text, r.n_lines, r.n_dropped, r.kept) for r in rows)
    assert got == sorted(key(d, t, *b) for (d, t), b in zip(docs, brute(docs, min_chars)))
    return df


EDGES = [
    (5, "first line of all\nSecond Line Here\nshort\nshort"), (3, "  FIRST LINE of all \x0b\nshort"), (9, None), (8, ""),
    (None, "second line here\nonly the nameless"), (None, "only the nameless\nfirst line of all"),
    (7, "second line here\nsecond line here\r\nown own own own"), (7, "first line of all"),
    (11, "ÄÖÜ ÄÖÜ ÄÖÜ\nNBSP line here "), (12, "äöü äöü äöü\nnbsp line here"), (13, "ÄÖÜ ÄÖÜ ÄÖÜ"),
    (20, "ninechars\nten chars!"), (21, "ninechars\nten chars!"), (22, "é" * 9 + "\n" + "é" * 10), (23, "é" * 9 + "\n" + "é" * 10),
    (30, "\n".join(f"line number {i}" for i in range(30_000))), (31, "\n".join(f"line number {i}" for i in range(0, 30_000, 3))),
    (5, "first line of all\nSecond Line Here\nshort\nshort")]


def test_edges_equal_brute_force(spark):
    df = compare(spark, EDGES)
    out = ld.dedup_lines(df)
    assert out.columns == df.columns and out.count() == len(EDGES)
    texts = {(r.doc_id, r.n_chars): r.text for r in out.collect()}
    assert all(n == len(t) for (_, n), t in texts.items() if t is not None)
    assert any(r.text is None for r in out.collect())
    assert ld.dedup_lines(df.limit(0)).collect() == [] and ld.keep_bitmaps(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ld.keep_bitmaps(df, 0)


def test_one_line_in_most_documents(spark):
    """A hash that spans many range partitions has one keeper."""
    rng = np.random.default_rng(2)
    docs = []
    for i in range(3_000):
        lines = ["the very common line"] * int(rng.integers(0, 3)) + [f"shared passage {rng.integers(0, 40)}", f"own line of {i} here"]
        rng.shuffle(lines)
        docs.append((int(i * 7 % 3_001), "\n".join(lines)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(spark, docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_keys_are_as_the_contract_says():
    for line in ["  A b\x0b", "É", " x ", "\x1cx", "TAB\there"]:
        assert ld.line_key(line.encode()).decode() == brute_key(line)


def test_registered_query_equals_brute_force(spark):
    from obslake.llm.queries import op8_line_dedup

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op8_line_dedup(spark, sf).collect()}
    assert rows == {d: (n, x, hashlib.sha256(k.encode()).hexdigest()) for (d, _), (n, x, k) in zip(docs, brute(docs))}
