"""Toxic passages by maximum-scoring segments.

Training counts, for hashed character pieces of words, in how many words of
labelled documents of either label each occurs, and turns the counts into
log-odds with an informative Dirichlet prior (every piece expected at one
rate in both labels, whatever the share of either).  Every piece whose
log-odds are significant tells, however little, for or against.  A word's
score is the mean log-odds of its pieces (0 for those that do not tell, none
for those too rare to tell anything) and a negative drift, so the slight leanings that much text makes significant cancel
out, and one piece shared with a toxic word does not condemn another.  One
linear scan per document (Ruzzo and Tompa) finds all maximal-scoring segments
of words.

Segments are judged by extreme-value statistics: in n words of clean text
about K n exp(-lambda s) segments reach a score s, where lambda solves the
moment equation of the clean words' scores and K is fitted to the segments
of the clean training documents.  A document's evidence is the sum over its
segments of how far each one is beyond chance; two logistic coefficients,
fitted to the training documents, make it a probability.

A document is found toxic too easily by pieces that it taught itself.  So the
calibration (lambda, K and the logistic) is cross-fitted: documents are dealt
into two halves by a hash of their text, and each half is scored by the pieces
that the other one teaches.

Memory is bounded: pieces are PIECES buckets, a document is scanned in
blocks of words, and its segments are numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import utf8, word_blocks, written

PIECES = 1 << 18
ORDERS = (4, 5)  # bytes in a piece of " word "
PRIOR = 0.1  # strength of the prior, as a share of the words of a label
SIGNIFICANT = 3.5  # standard errors of the log-odds
MIN_DOCUMENTS = 3  # labelled documents that a piece is in
DRIFT = -0.25
BINS_A_UNIT = 16  # of evidence, for the logistic fit
SCORE_BINS, SCORE_LIMIT = 100, 16  # of word scores: bins a unit, and the largest told apart
CHANCE = 0.05  # expected segments in clean text that a significant passage stays under
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
_MIX = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263, 374761393)]
BLOCK = 1 << 20  # bytes scanned together


def blocks(text: bytes) -> Iterator[bytes]:
    """The words of letters in lower case, one space between and around, in
    blocks of whole words."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    for words in word_blocks(text.translate(_LETTERS), BLOCK):
        yield b" " + b" ".join(words) + b" "


def pieces(block: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the pieces by order, one per byte (-1: none, as it would
    span two words), and the positions where words start."""
    b = np.frombuffer(block, np.uint8)
    space = b == 32
    starts = np.flatnonzero(space)[:-1]
    found = []
    for n in ORDERS:
        m = len(b) - n + 1
        out = np.full(len(b), -1, dtype=np.int64)
        if m > 0:
            h = np.full(m, n, dtype=np.uint32)
            inside = np.ones(m, dtype=bool)
            for k in range(n):
                h = (h ^ b[k:k + m]) * _MIX[k]
                if 0 < k < n - 1:
                    inside &= ~space[k:k + m]
            h ^= h >> np.uint32(13)
            out[:m] = np.where(inside, (h & np.uint32(PIECES - 1)).astype(np.int64), -1)
        found.append(out)
    return found, starts


def half() -> Column:
    """Which half a text is in: copies are in one."""
    return F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(2)).cast("int")


def piece_counts(texts: DataFrame) -> np.ndarray:
    """(2, PIECES + 1, 3) from ``text, toxic`` rows: for either half of the
    texts in how many words the piece occurs with label 0, with label 1, and in
    how many documents; the last row counts all words and documents.  A
    document counts each of its words once, so repeated lines weigh nothing,
    and a stem that it inflects counts with every form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, PIECES + 1, 3), dtype=np.int64)
        for batch in batches:
            for text, label, of in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                total = totals[of]
                words: set[bytes] = set()
                for block in blocks(text):
                    words.update(block.split())
                total[-1] += (len(words) * (label == 0), len(words) * (label == 1), 1)
                if words:
                    found = np.concatenate(pieces(b" " + b" ".join(words) + b" ")[0])
                    found = found[found >= 0]
                    np.add.at(total[:, label], found, 1)
                    total[np.unique(found), 2] += 1
        for of in (0, 1):
            at = np.flatnonzero(totals[of].any(axis=1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), of, dtype=np.int32)), pa.array(at),
                                              *[pa.array(totals[of][at, i]) for i in range(3)]],
                                             ["half", "piece", "n0", "n1", "docs"])

    rows = (texts.select("text", "toxic", half().alias("half"))
            .mapInArrow(run, "half int, piece int, n0 bigint, n1 bigint, docs bigint")
            .groupBy("half", "piece").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "docs")])
            .toArrow())  # at most PIECES + 1 rows a half
    out = np.zeros((2, PIECES + 1, 3), dtype=np.int64)
    out[rows["half"].to_numpy(), rows["piece"].to_numpy()] = np.stack([rows[c].to_numpy() for c in ("n0", "n1", "docs")], axis=1)
    return out


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log-odds of each piece for label 1 (below 0: for label 0), 0 where they
    are not significant, and none (NaN) where a piece is too rare for that: it
    would not be significant if all its words had label 1."""
    n0, n1 = counts[-1, :2] + 0.0
    if not n0 or not n1:
        return np.zeros(PIECES, dtype=np.float32)
    y0, y1 = counts[:-1, 0].astype(float), counts[:-1, 1].astype(float)

    def judged(y0: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # What the prior adds to either label: PRIOR of its words, with the
        # piece at the mean of its two rates, in half a word at least.  With one
        # rate for both, what a piece can reach does not depend on their mix.
        rate = np.maximum(PRIOR * (y0 / n0 + y1 / n1) / 2, 0.5 / min(n0, n1))

        def odds(y: np.ndarray, n: float) -> np.ndarray:
            return np.log((y + n * rate) / np.maximum(n + n * PRIOR + 1 - y - n * rate, 0.5))

        delta = odds(y1, n1) - odds(y0, n0)
        error = np.sqrt(1 / (y1 + n1 * rate) + 1 / (y0 + n0 * rate))
        return delta, (np.abs(delta) >= SIGNIFICANT * error) & (counts[:-1, 2] >= MIN_DOCUMENTS)

    delta, telling = judged(y0, y1)
    can_tell = telling | judged(np.zeros(PIECES), y0 + y1)[1]
    return np.where(telling, delta, np.where(can_tell, 0, np.nan)).astype(np.float32)


def word_scores(block: bytes, *models: np.ndarray) -> list[np.ndarray]:
    """Score of each word by each model: DRIFT and the mean log-odds of its
    pieces."""
    found, starts = pieces(block)
    out = []
    for scores in models:
        if not len(starts):
            out.append(np.zeros(0))
            continue
        known = [np.where(f >= 0, scores[f], np.nan) for f in found]
        told = np.add.reduceat(sum(np.nan_to_num(k) for k in known), starts)
        n = np.add.reduceat(sum((~np.isnan(k)).astype(np.int64) for k in known), starts)
        out.append(DRIFT + told / np.maximum(n, 1))
    return out


class Segments:
    """All maximal-scoring segments of a sequence of scores that come one
    after another, each with its range: Ruzzo and Tompa's linear scan.  Runs
    of drift come as one step."""

    def __init__(self) -> None:
        self.total = 0.0
        # Sum before, sum after, start, end, and the nearest earlier segment
        # with a smaller sum before it.
        self.open: list[tuple[float, float, int, int, int]] = []

    def add(self, score: float, start: int, end: int) -> None:
        left = self.total
        self.total = right = left + score
        if score <= 0:
            return
        j = len(self.open) - 1
        while True:
            while j >= 0 and self.open[j][0] >= left:
                j = self.open[j][4]
            if j < 0 or self.open[j][1] >= right:
                break
            left, _, start, _, before = self.open[j]
            del self.open[j:]
            j = before
        self.open.append((left, right, start, end, j))

    def found(self) -> list[tuple[float, int, int]]:
        return [(right - left, start, end) for left, right, start, end, _ in self.open]


class Scan:
    """Segments of a text that comes in blocks, and how many of its words have
    a score in each bin (from -SCORE_LIMIT to SCORE_LIMIT; those of DRIFT are
    left out)."""

    def __init__(self) -> None:
        self.scan, self.at = Segments(), 0
        self.histogram = np.zeros(2 * SCORE_LIMIT * SCORE_BINS + 1, dtype=np.int64)

    def add(self, s: np.ndarray) -> None:
        hits = np.flatnonzero(s > 0)
        below = np.concatenate([[0.0], np.cumsum(np.where(s > 0, 0, s))])
        last, at, scan = -1, self.at, self.scan
        for h, v in zip(hits.tolist(), s[hits].tolist()):
            if h - last > 1:
                scan.add(float(below[h] - below[last + 1]), at + last + 1, at + h)
            scan.add(v, at + h, at + h + 1)
            last = h
        if len(s) - last > 1:
            scan.add(float(below[len(s)] - below[last + 1]), at + last + 1, at + len(s))
        told = np.rint(np.clip(s[s != DRIFT], -SCORE_LIMIT, SCORE_LIMIT) * SCORE_BINS).astype(np.int64)
        self.histogram += np.bincount(told + SCORE_LIMIT * SCORE_BINS, minlength=len(self.histogram))
        self.at += len(s)


def segments(text: bytes, *models: np.ndarray) -> list[tuple[int, np.ndarray, list[tuple[float, int, int]]]]:
    """For each model the number of words, the histogram of their scores, and
    the segments as (score, first word, word after the last)."""
    scans = [Scan() for _ in models]
    for block in blocks(text):
        for scan, s in zip(scans, word_scores(block, *models)):
            scan.add(s)
    return [(s.at, s.histogram, s.scan.found()) for s in scans]


def find_passages(docs: DataFrame, scores: np.ndarray, crossed: list[np.ndarray]) -> DataFrame:
    """``doc_id, n_words, passages`` (maximal-scoring segments with word
    ranges, whole texts) by ``scores``, and by the pieces of the other half
    (``crossed[half]``) ``told`` (words by bin of their score, those of DRIFT
    left out) and ``cross_passages``."""
    shared = docs.sparkSession.sparkContext.broadcast((scores, crossed))  # PIECES floats each, 1 MB
    bins = pa.struct([("bin", pa.int32()), ("n", pa.int32())])
    passage = pa.struct([("score", pa.float32()), ("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("n_words", pa.int64()), ("passages", pa.list_(passage)), ("told", pa.list_(bins)),
                      ("cross_passages", pa.list_(passage))])

    @F.arrow_udf("n_words bigint, passages array<struct<score:float, start:int, end:int>>, "
                 "told array<struct<bin:int, n:int>>, cross_passages array<struct<score:float, start:int, end:int>>")
    def scan(text: pa.Array, of: pa.Array) -> pa.Array:
        rows = []
        final, crossed = shared.value
        for t, h in zip(utf8(text), of.to_pylist()):
            (n, _, found), (_, histogram, cross) = segments(t, final, crossed[h])
            at = np.flatnonzero(histogram)
            rows.append({"n_words": n,
                         "passages": [{"score": s, "start": a, "end": b} for s, a, b in found],
                         "told": [{"bin": b, "n": c} for b, c in zip((at - SCORE_LIMIT * SCORE_BINS).tolist(),
                                                                     histogram[at].tolist())],
                         "cross_passages": [{"score": s, "start": a, "end": b} for s, a, b in cross]})
        return pa.array(rows, kind)

    return docs.select("doc_id", scan(F.col("text"), half()).alias("s")).select("doc_id", "s.*")


def extreme_value_fit(n_words: int, histogram: list[tuple[float, int]], clean_segments: list[tuple[float, int]]
                      ) -> tuple[float, float]:
    """lambda and K from clean documents: their words, the histogram of their
    word scores other than DRIFT, and of their segments' scores (score, how many)."""
    # One telling word more than was seen: none seen does not mean never.
    top = max([s for s, _ in histogram if s > 0], default=1.0)
    counts = [*histogram, (top, 1)]
    words = max(n_words, 1) + 1.0
    told = min(sum(c for _, c in counts) / words, 1.0)
    shares = [(s, c / words) for s, c in counts]

    def moment(x: float) -> float:
        return sum(p * math.exp(min(x * s, 700)) for s, p in shares) + (1 - told) * math.exp(DRIFT * x) - 1

    low, high = 0.0, 1.0
    mean = sum(s * p for s, p in shares) + (1 - told) * DRIFT
    if mean >= 0:  # no negative drift: chance explains any segment
        return 1e-3, 1.0
    while moment(high) < 0 and high < 64:
        high *= 2
    low = 1e-6
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if moment(mid) < 0 else (low, mid)
    lam = (low + high) / 2
    # K: segments expected at the median segment's score equal those seen.
    total = sum(c for _, c in clean_segments)
    if not total:
        return lam, 1.0 / words
    seen, at = 0, clean_segments[0][0]
    for s, c in sorted(clean_segments, reverse=True):
        seen, at = seen + c, s
        if 2 * seen >= total:
            break
    return lam, min(max(seen / words * math.exp(min(lam * at, 700)), 1e-12), 1e12)


def _logistic(x: np.ndarray, n: np.ndarray, k: np.ndarray) -> tuple[float, float]:
    """Ridged logistic regression of k of n on x."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (k - n * p) - np.array([0.0, 0.01]) * w
        hess = design.T @ (design * (n * p * (1 - p))[:, None]) + np.diag([1e-6, 0.01])
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def evidence(lam: float, k: float, passages: str = "passages") -> Column:
    """Sum over the passages of -log(expected in clean text of this length),
    those within chance count nothing; log-scaled."""
    chance = F.log(F.lit(k) * F.greatest(F.col("n_words"), F.lit(1)))
    beyond = F.transform(passages, lambda s: F.greatest(s["score"] * lam - chance, F.lit(0.0)))
    return F.log1p(F.aggregate(beyond, F.lit(0.0), lambda a, x: a + x))


def labelled(docs: DataFrame, labels: DataFrame, parts: int = 4, held_out: int = 2) -> DataFrame:
    """``docs`` with ``toxic``: labelled documents whose crc32 of the id as
    text leaves another remainder than ``held_out``."""
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    taught = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held_out)
    # Labels are the side that is hashed: texts are not sorted, and the plan is
    # the same at any size.
    return taught.join(known.hint("shuffle_hash"), "doc_id")


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score`` (0 to 1), ``predicted`` (1 from ``threshold`` on) and
    ``passages``, the significant ones: score, word range and how many such
    passages clean text of this length would have.  A row per row of ``docs``.

    Only labels of the documents that :func:`labelled` leaves are used (a
    document labelled twice takes the larger label, labels other than 0 and 1
    and null ids teach nothing), and only the text makes a score.  Null and
    empty texts have no passage and the score of a text without evidence.
    Without labels of both kinds nothing is telling, and the score is the
    share of label 1 (a half without any label).  Repeated rows get a row
    each; an empty table none.  Other columns are ignored.
    """
    texts = docs.select("doc_id", "text")
    counts = piece_counts(labelled(texts, labels))
    found = written(find_passages(texts, log_odds(counts.sum(axis=0)), [log_odds(counts[1]), log_odds(counts[0])]), "toxic-passages")
    taught = written(labelled(found.select("doc_id", "n_words", "told", "cross_passages"), labels), "toxic-taught")

    clean = taught.filter("toxic = 0")
    n_words = clean.agg(F.sum("n_words")).first()[0] or 0
    by_bin = clean.select(F.inline("told")).groupBy("bin").agg(F.sum("n")).collect()  # at most as many as the bins
    # Scores of passages by the same bins, up to 200: twenty thousand rows at most.
    bins = F.round(F.least("p", F.lit(200.0)) * SCORE_BINS).cast("int").alias("bin")
    by_score = clean.select(F.explode("cross_passages.score").alias("p")).groupBy(bins).count().collect()
    lam, k = extreme_value_fit(n_words, *[[(r[0] / SCORE_BINS, r[1]) for r in rows] for rows in (by_bin, by_score)])

    cross = evidence(lam, k, "cross_passages")
    bins = taught.select(F.floor(cross * BINS_A_UNIT).alias("bin"), cross.alias("x"), "toxic").groupBy("bin").agg(
        F.avg("x").alias("x"), F.count("*").alias("n"), F.sum("toxic").alias("k")).orderBy("bin").collect()
    b0, b1 = _logistic(*[np.array([r[c] for r in bins], dtype=float) for c in ("x", "n", "k")]) if bins else (0.0, 0.0)
    x = evidence(lam, k)
    score = 1 / (1 + F.exp(-(F.lit(b0) + F.lit(b1) * x)))
    with_chance = F.transform("passages", lambda s: F.struct(
        s["score"].cast("double").alias("score"), s["start"].cast("bigint").alias("start"),
        s["end"].cast("bigint").alias("end"),
        (F.lit(k) * F.col("n_words") * F.exp(-F.lit(lam) * s["score"])).alias("expected")))
    return found.select(
        "doc_id", score.alias("score"), (score >= threshold).cast("int").alias("predicted"),
        F.filter(with_chance, lambda s: s["expected"] < CHANCE).alias("passages"))
