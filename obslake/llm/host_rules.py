"""Quality rules judged by host.

Every document is measured and tested by a few rules.  Failures are summed by
domain (partial sums first, so a domain with a third of all rows is a row per
task), a beta prior is fitted to the failure rates of all domains, and each
domain's rate is shrunk towards it: a domain with few documents hardly moves
away from the common rate.  Domains whose shrunk rate reaches a limit for
some rule are rejected as a whole, and this verdict goes back to their
documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import utf8, word_blocks, written

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
HOST_LIMIT = 0.5  # of the shrunk failure rate
PRIOR_MIN, PRIOR_MAX = 2.0, 1_000.0  # documents that the prior counts for


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words (given by number) covered by a window of words that is found
    twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    size = int(ids.max()) + 1
    # Equal runs of words get equal numbers, one word longer at a time; a run
    # that is not repeated cannot start a longer one that is.
    at, runs = np.arange(n), ids[:n]
    for k in range(1, window):
        _, runs = np.unique(runs * size + ids[at + k], return_inverse=True)
        again = np.bincount(runs)[runs] > 1
        at, runs = at[again], runs[again]
        if not len(at):
            return 0
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    parts, chars = [np.zeros(0, dtype=np.int64)], 0
    for words in word_blocks(text):
        parts.append(np.fromiter((number(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)))
        joined = b"".join(words)
        chars += len(joined)
        if not joined.isascii():  # bytes that go on with a character
            chars -= int(((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80).sum())
    ids = np.concatenate(parts)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(ids), chars, symbols, len(lines) - len(set(lines)), repeated_words(ids), len(lines))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` and the counts of MEASURES, whole texts, null as
    empty.  Lines count if they have a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t) for t in utf8(batch.column(2))], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(rows[:, i]) for i in range(len(MEASURES))]],
                ["doc_id", "source", *MEASURES])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), "text").mapInArrow(
        run, "doc_id bigint, source string, " + ", ".join(f"{m} bigint" for m in MEASURES))


def host(source: Column) -> Column:
    """The host of a URL, any other source itself, in lower case; null: empty."""
    url = F.regexp_extract(source, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(F.when(url != "", url), source, F.lit("")))


def failures() -> dict[str, Column]:
    """Rules of a document, true where it fails.  The first two are those
    that reject a document by themselves."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 100 * F.col("n_symbols") > 10 * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


BASE = ("few_words", "repeats")


def host_verdicts(tested: DataFrame, rules: list[str], limit: float = HOST_LIMIT) -> DataFrame:
    """``host, n_docs``, for each rule its shrunk rate ``rate_<rule>``, and
    ``host_kept``, of a table of ``host`` and booleans named by the rules.

    The prior of a rule has the mean and variance of the hosts' rates, the
    variance without what binomial noise adds (method of moments); it counts
    for PRIOR_MIN to PRIOR_MAX documents.
    """
    hosts = written(tested.groupBy("host").agg(
        F.count("*").alias("n_docs"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in rules]), "hosts")
    n = F.col("n_docs")
    stats = hosts.agg(F.sum(n).alias("docs"), F.count("*").alias("hosts"), F.sum(1 / n).alias("inverse"), *[
        x for r in rules for x in (F.sum(r).alias(f"k_{r}"), F.sum(F.col(r) / n).alias(f"m_{r}"),
                                   F.sum((F.col(r) / n) ** 2).alias(f"q_{r}"))]).first()
    rates = []
    for r in rules:
        if not stats["docs"]:
            a = b = 1.0
        else:
            mean = (stats[f"k_{r}"] + 0.5) / (stats["docs"] + 1.0)  # of documents, never 0 or 1
            rate = stats[f"m_{r}"] / stats["hosts"]
            noise = mean * (1 - mean) * stats["inverse"] / stats["hosts"]
            spread = max(stats[f"q_{r}"] / stats["hosts"] - rate * rate - noise, 1e-9)
            strength = min(max(mean * (1 - mean) / spread - 1, PRIOR_MIN), PRIOR_MAX)
            a, b = mean * strength, (1 - mean) * strength
        rates.append(((F.col(r) + F.lit(a)) / (n + F.lit(a + b))).alias(f"rate_{r}"))
    worst = F.greatest(*[F.col(f"rate_{r}") for r in rules]) if len(rules) > 1 else F.col(f"rate_{rules[0]}")
    return hosts.select("host", "n_docs", *rates).withColumn("host_kept", worst < limit)


def judge(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source``, the measures,
    ``base_failed`` (fewer than 10 words, or over a fifth of them repeated),
    ``host``, ``host_kept`` and ``kept`` (not base_failed, and its host is
    kept).

    Null texts have no words and fail; null sources are one host; a null
    doc_id is a document like others; repeated rows count each.  An empty
    table gives no rows.  Other columns are ignored.
    """
    rules = failures()
    found = written(measures(docs), "measures")
    tested = found.select("*", host(F.col("source")).alias("host"), *[c.alias(r) for r, c in rules.items()])
    verdicts = written(host_verdicts(tested, list(rules), limit), "verdicts")
    base = F.col(BASE[0]) | F.col(BASE[1])
    return tested.join(verdicts.select(F.col("host").alias("h"), "host_kept"), F.col("host") == F.col("h")).select(
        "doc_id", "source", *MEASURES, base.alias("base_failed"), "host", "host_kept",
        (~base & F.col("host_kept")).alias("kept"))
