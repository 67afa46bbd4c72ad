import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from obslake.llm import packing, tokens
from obslake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " \n", "Hello, world!", "İstanbul ǰ J̌ Å Å é ﬁ ß ẞ Ⅷ ²", "don't we'll I'd 'S x's", "a<|endoftext|>b <|startoftext|>",
         "<|EndOfText|>", "1234 5,6.7 -- ... ?! __a_b__", "日本語　テキスト x y", "\x1c\x1d a\x85b", "snow☃man 😀😀", "école École ÉCOLE, naïve.", "ª º µ ŉ ſ", "#hash @me http://x.y/z?q=1&r=%20",
         "Ωmega Σίσυφος ΣΑΣ", "ab\x00cd �", "́abc def́"]


def test_encoder_equals_the_library():
    whole = Tokenizer.from_file(tokenizer_path())
    enc = tokens.encoder(tokenizer_path())
    assert enc.by_piece
    for text in TEXTS:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(enc.encode((text or "").encode()), "<u4").tolist() == ids, text
    assert not tokens.Encoder(tokenizer_path("byte_bpe_50k.json")).by_piece


RANGES = [(32, 127), (9, 14), (0, 32), (0x80, 0x250), (0x2B0, 0x370), (0x370, 0x530), (0x600, 0x700), (0x900, 0x980),
          (0x1E00, 0x2100), (0x3000, 0x3100), (0xAC00, 0xAC80), (0xFB00, 0xFB50), (0x1F600, 0x1F640), (0x300, 0x330)]
PARTS = ["'s", "'S", "don't", " ", "a", "Z", "é", "É", "İ", "J\u030c", ".", "_", "|>", "<|endoftext|>", "1", "ª", "\xa0", "ß"]


def test_encoder_with_few_kept_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "_KEPT_PIECES", 3)
    enc = tokens.Encoder(tokenizer_path())
    text = " ".join(f"word{i % 7} the" for i in range(60))
    assert enc.encode(text.encode()) == enc.whole(text.encode())
    assert len(enc) <= 3 and len(enc.earlier) <= 3


def test_encoder_equals_the_library_on_random_texts():
    rng = np.random.default_rng(8)
    enc = tokens.Encoder(tokenizer_path())
    for i in range(4_000):
        if i % 3:
            spans = [RANGES[j] for j in rng.integers(0, len(RANGES), 3)]
            text = "".join(chr(rng.integers(*spans[rng.integers(0, 3)])) for _ in range(rng.integers(0, 14)))
        else:
            text = "".join(rng.choice(PARTS, rng.integers(0, 12)))
        assert np.frombuffer(enc.encode(text.encode()), "<u4").tolist() == \
            enc.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check(rows, docs, capacity, max_documents=None, max_attention=None):
    """Pieces join up to the documents, sequences are gapless and in bounds."""
    whole = Tokenizer.from_file(tokenizer_path())
    by_sequence = {}
    for r in rows:
        assert 0 < r.length <= capacity and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        assert sum(r.length for r in pieces) <= capacity
        assert len(pieces) <= (max_documents or capacity)
        assert sum(r.length ** 2 for r in pieces) <= (max_attention or capacity ** 2)
    expected = []
    for doc, text in docs:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(ids), capacity)):
            expected.append((doc if doc is not None else -1, i, at, np.array(ids[at:at + capacity], "<u4").tobytes()))
    got = [(r.doc_id if r.doc_id is not None else -1, r.piece, r.start, bytes(r.ids)) for r in rows]
    assert sorted(got) == sorted(expected)
    return by_sequence


def test_edges(spark):
    docs = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "no id"), (50, "long word soup " * 4_000)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, length int, ids string")
    check(packing.pack_documents(df, tokenizer_path(), capacity=64).collect(), docs, 64)
    assert packing.pack_documents(df.limit(0), tokenizer_path()).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(spark, rule):
    rng = np.random.default_rng(3)
    docs = [(i, "the " * int(n)) for i, n in enumerate(rng.integers(1, 70, 400))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    loose = check(packing.pack_documents(df, tokenizer_path(), 128, rule=rule).collect(), docs, 128)
    tight = check(packing.pack_documents(df, tokenizer_path(), 128, max_documents=3, max_attention=7_000, rule=rule,
                                         window_tokens=1_000).collect(), docs, 128, 3, 7_000)
    assert len(tight) > len(loose)
    with pytest.raises(ValueError):
        packing.VectorBestFit((1, 1, 1), (1, 1, 1), "first")


def test_lengths_of_other_splits_fill_sequences(spark):
    """Long documents in their own splits are joined with the short ones of others."""
    rng = np.random.default_rng(4)
    lengths = np.sort(np.concatenate([rng.integers(66, 120, 400), rng.integers(4, 60, 400)]))
    docs = [(i, "the " * int(n)) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(docs, 8), "doc_id bigint, text string")
    sequences = check(packing.pack_documents(df, tokenizer_path(), 128).collect(), docs, 128)
    assert len(sequences) <= 1.05 * (lengths + 1).sum() / 128 + 1


def test_few_sequences():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 4096, 3_000)
    fit = packing.VectorBestFit((4096, 4096, 4096 ** 2), (1.0, 1e-4, 1e-4), "norm")
    sequences = fit.place(lengths)
    assert sorted(i for s in sequences for i in s) == list(range(len(lengths)))
    assert max(lengths[s].sum() for s in sequences) <= 4096
    assert len(sequences) <= 1.04 * lengths.sum() / 4096


def test_residual_norm_picks_the_tightest():
    fit = packing.VectorBestFit((10, 10, 100), (1.0, 1e-4, 1e-4), "norm")
    assert sorted(map(sorted, fit.place(np.array([7, 6, 4, 3])))) == [[0, 3], [1, 2]]


@pytest.mark.parametrize("low, high, n", [(50, 90, 900), (43, 64, 1_200)])
def test_windows_do_not_change_the_number_of_sequences(spark, low, high, n):
    """Lengths that hardly pair: every window is stuck, and hands them on."""
    lengths = np.random.default_rng(3).integers(low, high, n)
    df = spark.createDataFrame([(i, "the " * int(x - 1)) for i, x in enumerate(lengths)], "doc_id bigint, text string")
    whole = len(packing.VectorBestFit((128, 128, 128 ** 2), (1.0, 1e-4, 1e-4), "norm").place(lengths))
    for capacities in (8, 32, 1024):
        rows = packing.pack_documents(df, tokenizer_path(), 128, window_tokens=capacities * 128)
        assert rows.select("sequence_id").distinct().count() == whole


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacities", [(128, 128, 128 ** 2), (128, 3, 7_000), (4096, 10, 4096 ** 2)])
def test_counts_are_placed_like_pieces(rule, capacities):
    rng = np.random.default_rng(6)
    fit = packing.VectorBestFit(capacities, (1.0, 1e-4, 1e-4), rule)
    for lengths in (rng.integers(1, 80, 2_000), rng.integers(20, 24, 500), np.full(77, 30), np.zeros(0, dtype=np.int64)):
        counts = {int(v): int(c) for v, c in zip(*np.unique(lengths, return_counts=True))}
        rows, n = fit.place_counts(counts)
        held = {i: [] for i in range(n)}
        for at, (length, first, sequence, each, offset) in enumerate(rows.tolist()):
            last = rows[at + 1][1] if at + 1 < len(rows) and rows[at + 1][0] == length else counts[length]
            for nth in range(int(last) - first):
                held[sequence + nth // each].append((offset + nth % each * length, length))
        assert sorted(x for h in held.values() for _, x in h) == sorted(lengths.tolist())
        for h in held.values():
            h.sort()
            assert [o for o, _ in h] == np.cumsum([0] + [x for _, x in h])[:-1].tolist()  # gapless
            assert sum(x for _, x in h) <= capacities[0] and len(h) <= capacities[1]
            assert sum(x * x for _, x in h) <= capacities[2]
        if rule == "norm":
            assert n == len(fit.place(lengths))


def test_registered_query(spark):
    from obslake.llm.queries import op9_best_fit_packing

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path()).collect()
    sequences = check(rows, docs, 4096)
    assert len(sequences) <= -(-sum(r.length for r in rows) // 4096) + 2
    digests = {(r.doc_id, r.piece): r.ids_crc32 for r in op9_best_fit_packing(spark, SF).collect()}
    assert digests == {(r.doc_id, r.piece): zlib.crc32(r.ids) for r in rows}
