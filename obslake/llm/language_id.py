"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams of its letters (A-Z lowered, all
else but non-ASCII bytes taken as a space), weighted by TF-IDF and
normalised.  Each language has several centroids, the clusters of a bounded
sample of its labelled texts (spherical k-means).  A text gets the language of the
centroid with the largest cosine, unless it is farther away than a limit
that the labelled texts themselves set: then it is rejected.  Short texts
have few n-grams and a small cosine with any centroid, so rejection looks at
the cosine over what a text of as many n-grams can be expected to reach.

Document frequencies and the limits count every labelled text; only the
clusters are fitted on a sample, of about ``sample`` texts a language, drawn by
hash.  A language with few texts has centroids that are close to those texts
and to little else, so it gets the limit of such centroids (see
:func:`floors`), not one of its own texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import packed, utf8, word_blocks

FEATURES = 1 << 13
ORDERS = (2, 3, 4)
CLUSTERS = 3
SAMPLE = 1_500
ROUNDS = 12
# Rejected are texts whose closeness is under this share of the least among
# nearly all labelled texts (those over the quantile) of the language.
REJECT_QUANTILE, REJECT_SHARE = 0.01, 0.5
FEW_TEXTS = 50  # fewer texts of a language do not set a limit
CLOSENESS_BINS, CLOSENESS_LIMIT = 200, 4  # bins a unit, and the largest told apart
HALF_WAY = 500  # distinct n-grams with which half of the squared cosine is expected
UNKNOWN = "und"
CHUNK = 1 << 20  # bytes of a text looked at together
ROWS_AT_ONCE = 64  # vectors multiplied together: 2 MB
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
_MIX = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263)]  # odd factors that spread bits


def term_counts(text: bytes) -> np.ndarray:
    """Counts of hashed n-grams over the whole text."""
    counts = np.zeros(FEATURES, dtype=np.int64)
    kept = b" " + b" ".join([b" ".join(w) for w in word_blocks(text.translate(_LETTERS))]) + b" "
    if len(kept) <= 2:
        return counts
    overlap = max(ORDERS) - 1
    for lo in range(0, len(kept), CHUNK):
        part = np.frombuffer(kept, np.uint8, min(CHUNK + overlap, len(kept) - lo), lo).astype(np.uint32)
        for n in ORDERS:
            starts = min(CHUNK, len(part) - n + 1)
            if starts <= 0:
                continue
            h = np.full(starts, n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ part[k:k + starts]) * _MIX[k]
            h ^= h >> np.uint32(15)
            counts += np.bincount(h & np.uint32(FEATURES - 1), minlength=FEATURES)
    return counts


def closeness(cosine: np.ndarray | float, distinct: np.ndarray | int) -> np.ndarray | float:
    return cosine * np.sqrt((distinct + HALF_WAY) / np.maximum(distinct, 1))


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    length = np.sqrt(v @ v)
    return (v / length if length else v).astype(np.float32)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over all texts: partial counts per task, then one row per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                total += term_counts(text) > 0
                n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)),
                                          pa.array(np.append(total[at], n))], ["feature", "n"])

    rows = texts.select("text").mapInArrow(run, "feature int, n bigint").groupBy("feature").agg(F.sum("n")).collect()
    df, n = np.zeros(FEATURES, dtype=np.int64), 0
    for feature, count in rows:
        if feature < 0:
            n = count
        else:
            df[feature] = count
    return df, n


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the text nearest the mean, then each
    time from the one farthest from the centres so far."""
    first = int(np.argmax(vectors @ vectors.mean(axis=0)))
    centres = vectors[[first]]
    while len(centres) < min(k, len(vectors)):
        centres = np.vstack([centres, vectors[int(np.argmin((vectors @ centres.T).max(axis=1)))]])
    for _ in range(ROUNDS):
        of = np.argmax(vectors @ centres.T, axis=1)
        sums = np.array([vectors[of == j].sum(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = sums / np.where(lengths > 0, lengths, 1)
    return centres.astype(np.float32)


def _centroids(texts: pa.Array, idf: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Vectors of a language's sampled texts, the centres of their clusters,
    and how close a text is to another one, against the centres.  Only the
    vectors are held: counts are of one text, products of a few."""
    vectors, distinct = np.empty((len(texts), FEATURES), dtype=np.float32), np.empty(len(texts), dtype=np.int64)
    for i, text in enumerate(utf8(texts)):
        counts = term_counts(text)
        vectors[i], distinct[i] = _vector(counts, idf), np.count_nonzero(counts)
    found = _clusters(vectors, clusters)
    before = np.roll(np.arange(len(vectors)), 1)
    others = closeness(np.concatenate([(vectors[lo:lo + ROWS_AT_ONCE] * vectors[before[lo:lo + ROWS_AT_ONCE]]).sum(axis=1)
                                       for lo in range(0, len(vectors), ROWS_AT_ONCE)]), distinct)
    near = closeness((vectors @ found.T).max(axis=1), distinct)
    alone = float(np.quantile(others, REJECT_QUANTILE) / max(np.quantile(near, REJECT_QUANTILE), 1e-9))
    return vectors, found, min(alone, 1.0)


class Model:
    """``languages`` of the centroids, the centroids, the weights of the
    features, and the closeness below which a centroid's language is rejected."""

    def __init__(self, languages: list[str], centroids: np.ndarray, idf: np.ndarray, floors: np.ndarray):
        self.languages, self.centroids, self.idf, self.floors = languages, centroids, idf, floors

    def predict(self, text: bytes) -> tuple[int, float, bool]:
        """Number of the centroid (-1 if nothing is shared), its cosine, and
        whether that is too far away."""
        counts = term_counts(text)
        v = _vector(counts, self.idf)
        if not len(self.languages) or not v.any():
            return -1, 0.0, True
        cosines = self.centroids @ v
        best = int(np.argmax(cosines))
        cosine = float(min(max(cosines[best], 0.0), 1.0))
        return best, cosine, bool(closeness(cosine, np.count_nonzero(counts)) < self.floors[best])


def _closeness_counts(texts: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """For each language how many of all its labelled texts have a closeness
    to its own centroids in each bin: partial counts per task."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    size = CLOSENESS_BINS * CLOSENESS_LIMIT + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        own = {lang: np.flatnonzero([x == lang for x in model.languages]) for lang in set(model.languages)}
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if lang not in own:
                    continue
                counts = term_counts(text)
                cosine = float((model.centroids[own[lang]] @ _vector(counts, model.idf)).max())
                near = closeness(max(cosine, 0.0), max(np.count_nonzero(counts), 1))
                bins = total.setdefault(lang, np.zeros(size, dtype=np.int64))
                bins[int(min(near, CLOSENESS_LIMIT) * CLOSENESS_BINS)] += 1
        rows = [(lang, int(b), int(bins[b])) for lang, bins in total.items() for b in np.flatnonzero(bins)]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                                          pa.array(columns[2], pa.int64())], ["lang", "bin", "n"])

    rows = texts.select("lang", "text").mapInArrow(run, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(
        F.sum("n")).collect()  # bins of the model's languages
    out: dict[str, np.ndarray] = {}
    for lang, at, n in rows:
        out.setdefault(lang, np.zeros(size, dtype=np.int64))[at] = n
    return out


def floors(counts: dict[str, np.ndarray], alone: float) -> dict[str, float]:
    """The limit of each language: a share of the closeness that nearly all its
    texts reach.  One with fewer than FEW_TEXTS texts gets the least of the
    others' limits (that of all texts together, if all have few), times
    ``alone``, the closeness that a text has to single texts of its language as
    a share of that to the language's centroids."""
    def limit(bins: np.ndarray) -> float:
        reached = np.cumsum(bins) > REJECT_QUANTILE * (bins.sum() - 1)
        return float(np.argmax(reached)) / CLOSENESS_BINS * REJECT_SHARE

    known = {lang: limit(bins) for lang, bins in counts.items() if bins.sum() >= FEW_TEXTS}
    common = alone * (min(known.values()) if known else limit(sum(counts.values()))) if counts else 0.0
    return {lang: known.get(lang, common) for lang in counts}


def draw() -> Column:
    """A number from 0 to 1 for each document, of 63 bits: a sample by it
    stays about as large as it is meant to at any size of the table."""
    return F.xxhash64("doc_id", F.xxhash64("text")).bitwiseAND(F.lit(2**63 - 1)) / F.lit(float(2**63))


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """From ``doc_id, text, lang`` rows; those with a null text or language,
    or without a letter, are left out.  The driver gets document frequencies
    (FEATURES rows), a few centroids and CLOSENESS_BINS counts per language:
    meant for the languages of a label column, thousands at most."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, n = _document_frequencies(usable)
    idf = np.log((1 + n) / (1 + df)) + 1
    # One row per language, as many as the model has names.
    counts = usable.groupBy("lang").count().collect()
    shares = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, sample / n)]) if counts else None
    drawn = usable.filter(draw() < F.element_at(shares, F.col("lang"))) if counts else usable

    def centroids(key: tuple, rows: pa.Table) -> pa.Table:
        vectors, found, alone = _centroids(rows.column("text").combine_chunks(), idf, clusters)
        n = len(found)
        return pa.table({"lang": [key[0].as_py()] * n, "centroid": list(found), "texts": [len(vectors)] * n,
                         "alone": [alone] * n},
                        schema=pa.schema([("lang", pa.string()), ("centroid", pa.list_(pa.float32())),
                                          ("texts", pa.int32()), ("alone", pa.float64())]))

    rows = drawn.select("lang", "text").groupBy("lang").applyInArrow(
        centroids, "lang string, centroid array<float>, texts int, alone double").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    stacked = np.array([r["centroid"] for r in rows], dtype=np.float32).reshape(-1, FEATURES)
    names = [r["lang"] for r in rows]
    model = Model(names, stacked, idf.astype(np.float32), np.zeros(len(rows)))
    # one text alone is close to itself and tells nothing
    told = [r for r in rows if r["texts"] >= FEW_TEXTS] or [r for r in rows if r["texts"] > 1]
    alone = min([r["alone"] for r in told], default=0.0)
    limits = floors(_closeness_counts(usable, model), alone) if rows else {}
    return Model(names, stacked, model.idf, np.array([limits.get(x, 0.0) for x in names]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred``, ``score`` (cosine,
    0 to 1) and ``rejected``.  Only the text decides.

    Texts that are null or have no letter are ``und`` with score 0 and
    rejected; so is everything if nothing was learned.  Equal cosines go to
    the first language in code point order.  Repeated rows, null ids and
    other columns are passed through; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<best:int, score:double, far:boolean>")
    def nearest(text: pa.Array) -> pa.Array:
        model = shared.value
        best, score, far = zip(*map(model.predict, utf8(text))) if len(text) else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(best, pa.int32()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
            ["best", "score", "far"])

    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(packed(docs), spoken.alias("spoken"), nearest(F.when(spoken, F.col("text"))).alias("n"))
    known = F.col("spoken") & (F.col("n.best") >= 0)
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array().cast("array<string>")
    return rows.select(
        "row", F.when(known, F.get(names, F.col("n.best"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col("n.score")).otherwise(0.0).alias("score"),
        (~known | F.col("n.far")).alias("rejected"))


def learnable(docs: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """Documents whose crc32 of the id as text leaves another remainder than
    ``held_out``; null ids are never learned from."""
    return docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held_out)


def spoken_documents(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without those that a model of their own labels
    rejects: texts that are null, empty or without a letter, and texts far
    from every language learned (all, if nothing was learned).  Rows with a
    null id stay or go by their text; repeated rows do so together."""
    kept = predict(docs, fit(learnable(docs))).filter(~F.col("rejected"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
