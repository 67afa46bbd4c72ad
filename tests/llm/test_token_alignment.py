import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import token_alignment as ta
from obslake.llm.queries import op11_token_alignment, tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TEXTS = [None, "", " ", "  ", "Hello, world!", "don't  stop\n\n\tnow", "naïve café ﬁ ß 日本語　テキスト 😀😀", "<|endoftext|> <s> </s> <unk> <0x41>",
         "a\x00b", "▁ under▁score ▁", "é é", "1234567 8,900.00", "x" * 500, "ab " * 300, "\r\n", "é" * 80, " lead", "trail ", "İ"]


@pytest.fixture(scope="module")
def files():
    return ta.ByteLevel(tokenizer_path(A)), ta.Pieces(tokenizer_path(B))


def spans(ids, of):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(of[i]), i))
        at += len(of[i])
    return out


def brute(rows, files):
    """Rows of the operator, straight from its contract."""
    a, b = files
    docs = []
    for doc, text in rows:
        ia = a.tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ib = b.model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(s.bytes[i] for i in ids) != whole for s, ids in ((a, ia), (b, ib))):
            docs.append((doc, [], [], []))
            continue
        sa, sb = spans(ia, a.bytes), spans(ib, b.bytes)
        cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups = [([i for s, e, i in sa if lo <= s and e <= hi], [i for s, e, i in sb if lo <= s and e <= hi])
                  for lo, hi in zip([0, *cuts], cuts)]
        links = [(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]]
        docs.append((doc, ia, groups, links))
    count = Counter(link for d in docs for link in d[3])
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc, ia, groups, links in docs:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(ia), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(shown.encode()).hexdigest() if ia else ""))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(df):
    return sorted(map(tuple, ta.align(df, tokenizer_path(A), tokenizer_path(B)).select(*COLUMNS).collect()), key=repr)


def test_odd_texts_equal_brute_force(spark, files, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "Hello, world!"), (None, "Hello"), (None, None), (2, "Hello again, world")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows, files)
    assert run(df) == want
    assert sum(w[1] == 0 for w in want) >= 4 and any(w[3] < w[2] for w in want)


def test_documents_equal_brute_force(spark, files):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if r[1] is None or len(r[1]) < 4000]
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows, files)


def test_query_covers_the_table(spark, files):
    sf = "/root/testdata/sf0.001"
    got = op11_token_alignment(spark, sf)
    assert got.columns == COLUMNS
    rows = got.collect()
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    a, b = files
    for r in rows:
        assert r["n_a"] == len(a.tokenizer.encode(" " + texts[r["doc_id"]], add_special_tokens=False).ids)
        assert r["n_b"] == len(b.model.encode(texts[r["doc_id"]]))


WORDS = ["the", "Wörter", "don't", "--", "a.b", "x1", "", "\n", "\nline", "日本", "naïve", "(and)", "'s", "1 2", "é", "\t", "a\r",
         "\xa0x", "　", "\n\n", "end.\n", "\u200b", "́", "café", "İ", "☃", "\x85", "\x1c"]


def test_units_have_the_tokens_of_the_whole(files):
    rng = random.Random(5)
    a, b = files
    assert a.cuts and b.cuts
    texts = ["".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "", "\n"]) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    texts = [t.encode() for t in texts if t]
    chunk = ta.Chunk(a, b)
    chunk.add(list(range(len(texts))), texts)
    keys = {int(p): k for k, p in zip(chunk.number, chunk.place) if p >= 0}
    tokens = [np.split(np.concatenate(side), np.cumsum(chunk.sizes[:-1, x])) for x, side in enumerate(chunk.tokens)]
    for text, (doc, n_a, n_b, _, mine, sha) in zip(texts, chunk.docs):
        if not sha:
            continue
        assert b"".join(ta.unit_text(keys[u]) for u in mine.tolist()) == b" " + text
        ids = [np.concatenate([side[u] for u in mine]).tolist() for side in tokens]
        assert ids == [a.tokenizer.encode(" " + text.decode(), add_special_tokens=False).ids, b.model.encode(text.decode())]
    assert sum(not d[5] for d in chunk.docs) < len(texts) / 2 and len(chunk.shown) < sum(len(d[4]) for d in chunk.docs)


def test_files_that_may_not_be_cut_are_encoded_whole(files, monkeypatch):
    texts = [t.encode() for t in TEXTS if t]
    cut, whole = ta.Chunk(*files), ta.Chunk(*files)
    cut.add(list(range(len(texts))), texts)
    monkeypatch.setattr(files[0], "cuts", False)
    whole.add(list(range(len(texts))), texts)
    assert [(d[:4], d[5]) for d in cut.docs] == [(d[:4], d[5]) for d in whole.docs]
    assert len(whole.shown) == len(set(texts))


def test_many_chunks_equal_one(spark, files):
    rows = [(i, f"the cat number {i % 7} sat on mat {i % 5}, naïve\nnext") for i in range(60)]
    one = ta.Chunk(*files)
    one.add([i for i, _ in rows], [t.encode() for _, t in rows])
    many = []
    for first in range(0, 60, 13):
        chunk = ta.Chunk(*files)
        part = rows[first:first + 13]
        chunk.add([i for i, _ in part], [t.encode() for _, t in part])
        many.append(chunk.rows(first))

    def total(batches):
        got = Counter()
        for batch in batches:
            book = batch.to_pylist()[-1]
            got.update(dict(zip(book["pairs"], book["times"])))
        return got

    assert total(many) == total([one.rows(0)])
    aligned = spark.createDataFrame([r for b in many for r in b.to_pylist()], ta.ALIGNED)
    best = {r["pair"]: (r["count"], r["best"]) for r in ta.pair_counts(aligned).collect()}
    assert {p: n for p, (n, _) in best.items()} == total([one.rows(0)])


def test_coalescing_breaks_where_both_sides_end():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, size=rng.integers(1, 20)), n)) for _ in "ab")
        order, first = ta.coalesce(a, b)
        starts = np.concatenate([np.append(0, a[:-1]), np.append(0, b[:-1])])[order]
        assert starts[first].tolist() == [0, *np.intersect1d(a, b)[:-1].tolist()]
        at_a, at_b = ta.overlaps(a, b)
        sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]]
        assert list(zip(at_a.tolist(), at_b.tolist())) == want


def test_empty_table_and_clashing_columns(spark):
    assert run(spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert run(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    df = spark.createDataFrame([(1, "same words here")], "doc_id bigint, text string")
    more = df.withColumns({c: F.lit("?") for c in ("chunk", "pairs", "units", "n_a", "count", "pair", "at")})
    assert run(more) == run(df)
