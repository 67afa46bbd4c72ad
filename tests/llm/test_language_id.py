import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obslake.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_counts_do_not_depend_on_the_chunk(monkeypatch):
    text = ("Dér Text, mit 42 Wörtern und Ähnlichem! " * 300).encode()
    whole = li.term_counts(text)
    monkeypatch.setattr(li, "CHUNK", 1_000)
    assert (li.term_counts(text) == whole).all()
    n = len(b" " + b" ".join(text.translate(li._LETTERS).split()) + b" ")
    assert whole.sum() == sum(n - k + 1 for k in li.ORDERS)
    assert not li.term_counts(b"").any() and not li.term_counts(b"12 !?").any()


def test_clusters_are_unit_vectors_near_their_texts():
    rng = np.random.default_rng(0)
    centres = np.eye(3, 20)
    vectors = np.vstack([c + 0.05 * rng.random((30, 20)) for c in centres])
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    found = li._clusters(vectors, 3)
    assert np.allclose(np.linalg.norm(found, axis=1), 1, atol=1e-4)
    assert ((vectors @ found.T).max(axis=1) > 0.97).all() and len({int(x) for x in np.argmax(found, axis=1)}) == 3
    assert len(li._clusters(vectors[:1], 3)) == 1


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from obslake.llm.queries import op3_language_id

    return {r.doc_id: (r, q) for r, q in zip(docs.orderBy("doc_id").collect(), op3_language_id(spark, SF).orderBy("doc_id").collect())}


def test_held_out_accuracy(found):
    held = [(r, q) for r, q in found.values() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 250 and all(q.held_out for _, q in held) and sum(q.held_out for _, q in found.values()) == len(held)
    assert np.mean([r.lang == q.lang_pred for r, q in held]) > 0.98
    assert all(0 <= q.score <= 1 for _, q in found.values())


def test_clean_documents_are_not_rejected(found):
    assert not any(q.rejected for _, q in found.values())


@pytest.mark.parametrize("n", [1, 2, 3])
def test_a_language_with_few_texts_rejects_none_of_its_own(spark, n):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = li.learnable(docs)
    few = base.filter("lang = 'de'").orderBy("doc_id").limit(n)
    model = li.fit(base.filter("lang <> 'de'").unionByName(few))
    assert li.predict(docs.filter("lang = 'de'"), model).filter("rejected").count() == 0


def test_limits_count_every_text_and_equal_brute_force(spark):
    docs = li.learnable(spark.read.parquet(f"{SF}/documents.parquet"))
    model = li.fit(docs, sample=60)
    rows = [(r.lang, r.text.encode()) for r in docs.collect()]
    near = {}
    for lang, text in rows:
        counts = li.term_counts(text)
        own = [i for i, x in enumerate(model.languages) if x == lang]
        cosine = float((model.centroids[own] @ li._vector(counts, model.idf)).max())
        near.setdefault(lang, []).append(li.closeness(cosine, np.count_nonzero(counts)))
    for lang, values in near.items():
        values.sort()
        floor = values[int(li.REJECT_QUANTILE * (len(values) - 1))] * li.REJECT_SHARE
        at = model.floors[model.languages.index(lang)]
        assert abs(at - floor) <= 1 / li.CLOSENESS_BINS, lang


def test_every_prediction_equals_brute_force(spark, found):
    """The whole query: centroids of the model compared one by one."""
    from obslake.llm.queries import table

    docs = table(spark, SF, "documents")
    model = li.fit(li.learnable(docs, parts=3, held_out=1))
    for r, q in list(found.values()):
        counts = li.term_counts(r.text.encode())
        v = np.log1p(counts) * model.idf.astype(float)
        v /= np.linalg.norm(v) or 1
        cosines = [float(c.astype(float) @ v) for c in model.centroids]
        best = int(np.argmax(cosines))
        assert abs(cosines[best] - q.score) < 1e-5
        assert model.languages[best] == q.lang_pred or max(
            c for c, x in zip(cosines, model.languages) if x == q.lang_pred) > cosines[best] - 1e-5


def test_a_small_share_is_drawn_at_that_share(spark):
    n = spark.range(20_000_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).filter(
        li.draw() < 1e-7).count()
    assert n < 12  # two are expected; steps of a millionth would let twenty through


def test_edges(spark):
    words = {"de": "der und die Straße ist schön heute Abend wieder", "en": "the and that with this from which there here"}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(words[lang].split(), 12)), lang, "s", 0.5, "x") for i in range(60) for lang in [("de", "en")[i % 2]]]
    rows += [(70, None, "de", "s", 0.1, "x"), (71, "", "en", "s", 0.1, "x"), (72, "12 -- 3", None, None, 0.1, "x"), (None, "the and this", "en", "s", 0.1, "x"),
             (73, "der die und", None, None, 0.1, "x"), (74, "the and that " * 100_000, "en", "s", 0.1, "x"), (1, "the with", "en", "s", 0.1, "x"),
             (75, "Тут всё иначе", None, "s", 0.1, "x"), (76, "qzx jqx vzk xqj kzv jxq wqz zzx " * 9, None, "s", 0.1, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double, rejected string")
    model = li.fit(li.learnable(df))
    out = li.predict(df, model).collect()
    assert len(out) == len(rows) and sorted(set(model.languages)) == ["de", "en"]
    pred = {(r.row.doc_id, r.row.text): r for r in out}
    assert all(pred[(i, t)].lang_pred == "und" and pred[(i, t)].score == 0 and pred[(i, t)].rejected
               for i, t in ((70, None), (71, ""), (72, "12 -- 3")))
    assert pred[(73, "der die und")].lang_pred == "de" and pred[(None, "the and this")].lang_pred == "en"
    assert pred[(75, "Тут всё иначе")].rejected and pred[(76, rows[-1][1])].rejected
    kept = li.spoken_documents(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 5
    assert li.predict(df.limit(0), model).collect() == []
    nothing = li.fit(df.limit(0))
    assert nothing.languages == [] and {r.lang_pred for r in li.predict(df, nothing).collect()} == {"und"}
    assert li.spoken_documents(df.limit(0)).collect() == []


def test_clusters_hold_one_copy_of_the_vectors():
    rng = np.random.default_rng(5)
    words = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(3_000)])
    texts = pa.array([" ".join(rng.choice(words, 60)) for _ in range(300)])
    idf = np.linspace(1, 2, li.FEATURES)
    tracemalloc.start()
    vectors, found, alone = li._centroids(texts, idf, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert vectors.nbytes == 300 * li.FEATURES * 4
    assert peak < 2.5 * vectors.nbytes  # with the copy of a cluster; counts of all texts alone are twice the vectors
    counts = [li.term_counts(t.encode()) for t in texts.to_pylist()]
    plain, distinct = np.array([li._vector(c, idf) for c in counts]), np.array([np.count_nonzero(c) for c in counts])
    others = li.closeness((plain * np.roll(plain, 1, axis=0)).sum(axis=1), distinct)
    near = li.closeness((plain @ found.T).max(axis=1), distinct)
    assert (vectors == plain).all() and (found == li._clusters(plain, 3)).all()
    assert alone == min(float(np.quantile(others, li.REJECT_QUANTILE) / np.quantile(near, li.REJECT_QUANTILE)), 1.0)
