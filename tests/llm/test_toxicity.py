import zlib

import numpy as np
import pytest

from obslake.llm import toxicity as tx


def brute_segments(scores):
    """Maximal-scoring segments by their definition: the best contiguous run
    (shortest, leftmost), then the same to its left and right."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-9 and (top is None or total > top[0] + 1e-9 or (abs(total - top[0]) < 1e-9 and j + 1 - i < top[2] - top[1])):
                    top = (total, i, j + 1)
        if top is None:
            return []
        return best(lo, top[1]) + [top] + best(top[2], hi)
    return best(0, len(scores))


def test_scan_equals_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(200):
        n = int(rng.integers(0, 30))
        scores = [float(x) for x in rng.normal(-0.2, 1, n)]
        scan = tx.Segments()
        for i, s in enumerate(scores):
            scan.add(s, i, i + 1)
        got = scan.found()
        expected = brute_segments(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in expected]
        assert np.allclose([s for s, *_ in got], [s for s, *_ in expected])


def test_textbook_example():
    """Ruzzo and Tompa's example sequence."""
    scan = tx.Segments()
    for i, s in enumerate([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]):
        scan.add(s, i, i + 1)
    assert [(s, a, b) for s, a, b in scan.found()] == [(4, 0, 1), (3, 2, 3), (7, 4, 11)]


def test_blocks_do_not_change_the_result(monkeypatch):
    rng = np.random.default_rng(0)
    text = " ".join("".join(rng.choice(list("abcdeé"), int(rng.integers(1, 9)))) for _ in range(2_000)).encode()
    scores = np.where(rng.random(tx.PIECES) < 0.05, 3.0, 0).astype(np.float32)
    (whole,) = tx.segments(text, scores)
    monkeypatch.setattr(tx, "BLOCK", 500)
    (parts,) = tx.segments(text, scores)
    assert whole[0] == parts[0] == 2_000 and np.allclose(whole[1], parts[1])
    assert [x[1:] for x in whole[2]] == [x[1:] for x in parts[2]]
    assert tx.segments(b"", scores)[0][0] == 0 and tx.segments(b"42 !", scores)[0][2] == []


def test_extreme_value_fit_solves_its_equation():
    lam, k = tx.extreme_value_fit(100_000, [(1.0, 500), (2.0, 100)], [(1.0, 400), (2.0, 90), (3.0, 5)])
    p = {1.0: 500 / 100_001, 2.0: 101 / 100_001}
    assert sum(q * np.exp(lam * s) for s, q in p.items()) + (1 - sum(p.values())) * np.exp(tx.DRIFT * lam) == pytest.approx(1, abs=1e-4)
    assert k > 0
    assert all(np.isfinite(tx.extreme_value_fit(0, [], [])))


INSULTS = ["blorgface", "gnarfling"]
SCHEMA = "doc_id bigint, text string, lang string, score double, predicted string"


def corpus(spark, n=400):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeioustrnl"), int(rng.integers(2, 8)))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, int(rng.integers(5, 120)))]
        toxic = int(i % 4 == 0)
        for _ in range(toxic * int(rng.integers(1, 4))):
            text.insert(int(rng.integers(0, len(text) + 1)), str(rng.choice(INSULTS)) + str(rng.choice(["", "s", "!"])))
        docs.append((i, " ".join(text), "en", 0.1, "x"))
        labels.append((i, toxic))
    docs += [(n, None, None, 0.1, "x"), (n + 1, "", "en", 0.1, "x"), (None, "you Blorgface", "en", 0.1, "x"), (n + 2, "plain " * 200_000 + "gnarfling", "en", 0.1, "x"),
             (3, docs[3][1], "en", 0.1, "x")]
    labels += [(None, 1), (n + 1, None), (n, 7), (5, 0), (5, 0)]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_and_edges(spark):
    docs, labels = corpus(spark)
    rows = tx.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by = {r.doc_id: r for r in rows}
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 60 and np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert by[None].predicted == 1 and by[400].predicted == by[401].predicted == 0 and by[400].passages == []
    assert len(by[402].passages) == 1 and by[402].passages[0].start == 200_000
    hits = [r for r in held if r.doc_id % 4 == 0]
    texts = {r.doc_id: r.text.split() for r in docs.collect() if r.text}
    for r in hits:
        spans = [texts[r.doc_id][p.start:p.end] for p in r.passages]
        assert spans and all(any(w.startswith(tuple(INSULTS)) for w in s) for s in spans)
    assert tx.score_toxicity(docs.limit(0), labels).collect() == []
    blind = tx.score_toxicity(docs, labels.limit(0)).collect()
    assert len(blind) == len(rows) and len({round(r.score, 9) for r in blind}) == 1


def test_every_score_equals_brute_force(spark):
    """The whole operator again, text by text: pieces of either half, segments
    by the definition, evidence and the logistic."""
    docs, labels = corpus(spark, 240)
    rows = docs.select("doc_id", "text", tx.half().alias("half")).collect()
    toxic = {}
    for r in labels.collect():
        if r.toxic in (0, 1) and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            toxic[r.doc_id] = max(r.toxic, toxic.get(r.doc_id, 0))
    counts = np.zeros((2, tx.PIECES + 1, 3), dtype=np.int64)
    for r in rows:
        if r.doc_id not in toxic:
            continue
        words = set((r.text or "").lower().replace("!", " ").split())
        mine, label = counts[r.half], toxic[r.doc_id]
        mine[-1, label] += len(words)
        mine[-1, 2] += 1
        seen = set()
        for w in words:
            for of in tx.pieces(f" {w} ".encode())[0]:
                for piece in of[of >= 0].tolist():
                    mine[piece, label] += 1
                    seen.add(piece)
        for piece in seen:
            mine[piece, 2] += 1
    final = tx.log_odds(counts[0] + counts[1])
    crossed = [tx.log_odds(counts[1]), tx.log_odds(counts[0])]

    def scan(text, model):
        scores = []
        for w in (text or "").lower().replace("!", " ").split():
            known = [float(model[p]) for of in tx.pieces(f" {w} ".encode())[0] for p in of[of >= 0].tolist()]
            known = [x for x in known if not np.isnan(x)]
            scores.append(tx.DRIFT + (sum(known) / len(known) if known else 0))
        return scores

    def found(scores):
        s = tx.Segments()
        for i, x in enumerate(scores):
            s.add(x, i, i + 1)
        return [float(np.float32(x)) for x, _, _ in s.found()]

    short = [r for r in rows if len(r.text or "") < 10_000]
    n_words, told, seen = 0, {}, {}
    for r in rows:
        if toxic.get(r.doc_id) == 0:
            scores = scan(r.text, crossed[r.half])
            n_words += len(scores)
            for x in scores:
                if x != tx.DRIFT:
                    b = round(min(max(x, -16), 16) * 100) / 100
                    told[b] = told.get(b, 0) + 1
            for x in found(scores):
                b = round(min(x, 200.0) * 100) / 100
                seen[b] = seen.get(b, 0) + 1
    lam, k = tx.extreme_value_fit(n_words, list(told.items()), list(seen.items()))

    def evidence(scores):
        chance = np.log(k * max(len(scores), 1))
        return np.log1p(sum(max(x * lam - chance, 0.0) for x in found(scores)))

    x = [(evidence(scan(r.text, crossed[r.half])), toxic[r.doc_id]) for r in rows if r.doc_id in toxic]
    bins = {}
    for e, t in x:
        bins.setdefault(int(np.floor(e * tx.BINS_A_UNIT)), []).append((e, t))
    fit = [(np.mean([e for e, _ in v]), len(v), sum(t for _, t in v)) for _, v in sorted(bins.items())]
    b0, b1 = tx._logistic(*[np.array(c, dtype=float) for c in zip(*fit)])
    want = sorted((r.doc_id if r.doc_id is not None else -1, 1 / (1 + np.exp(-(b0 + b1 * evidence(scan(r.text, final)))))) for r in short)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.score) for r in tx.score_toxicity(docs, labels).collect() if r.doc_id != 242)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert np.allclose([g for _, g in got], [w for _, w in want], atol=2e-3)


def test_labels_of_held_out_documents_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in tx.score_toxicity(docs, labels).collect()}
    assert a == pytest.approx({r.doc_id: r.score for r in tx.score_toxicity(docs, flipped).collect()})


def counted(n0, n1, rows):
    """Counts of pieces in ``n0`` and ``n1`` words of either label."""
    counts = np.zeros((tx.PIECES + 1, 3), dtype=np.int64)
    counts[:len(rows)], counts[-1] = rows, (n0, n1, 10_000)
    return counts


@pytest.mark.parametrize("share", [0.1, 0.5, 0.62, 0.9])
def test_every_significant_piece_tells_at_any_label_mix(share):
    n0, n1 = round(1_000_000 * (1 - share)), round(1_000_000 * share)
    rows = [(n0 // 100, n1 // 50, 500),  # twice as often in label 1
            (n0 // 50, n1 // 100, 500),  # in label 0
            (n0 // 100, n1 // 100, 500),  # as often in both
            (0, n1 // 100, 500)]  # in label 1 only
    twice, half, even, only = tx.log_odds(counted(n0, n1, rows))[:4]
    assert 0.5 < twice < 0.8 and -0.8 < half < -0.5 and even == 0
    assert only == pytest.approx(np.log(1 + 2 / tx.PRIOR), abs=0.05)


def test_slight_leanings_keep_their_score_and_cancel_out():
    scores = np.zeros(tx.PIECES, dtype=np.float32)
    for word, odds in ((b"abcd", 0.75), (b"wxyz", -0.25)):
        for found in tx.pieces(b" " + word + b" ")[0]:
            scores[found[found >= 0]] = odds
    assert tx.word_scores(b" abcd wxyz plain ", scores)[0].tolist() == [0.5, -0.5, tx.DRIFT]
    ((n, told, found),) = tx.segments(b"abcd wxyz plain abcd", scores)
    assert n == 4 and [s for s, *_ in found] == [0.5, 0.5]
    at = np.flatnonzero(told)
    assert ((at - tx.SCORE_LIMIT * tx.SCORE_BINS) / tx.SCORE_BINS).tolist() == [-0.5, 0.5] and told[at].tolist() == [1, 2]
    # Most words tell slightly, half of them against: segments stay rare.
    lam, k = tx.extreme_value_fit(100_000, [(0.1, 45_000), (-0.35, 45_000)], [(0.1, 9_000), (0.5, 20)])
    assert lam > 1 and np.isfinite(k)
