import re

import numpy as np
import pytest

from obslake.llm import host_rules as hr

SCHEMA = "doc_id bigint, text string, source string, n_words int, host string, kept string"


def brute_measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            again |= {p + k for p in places for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again), len(lines))


TEXTS = [None, "", " \n\t", "a", "a a a a a a", "a b c d e x a b c d e", "a b c d e a b c d", "x " * 12, "é 😀 #*$%&|<>\n \nz",
         "l one\nl one\nl one \n\nl one", "to be or not to be or not to be or not", "p q r s t u v w x y z " * 2, "  nbsp word"]


@pytest.mark.parametrize("text", TEXTS)
def test_measures_equal_brute_force(text):
    assert hr.measure((text or "").encode()) == brute_measure(text)


def test_measures_equal_brute_force_at_random():
    rng = np.random.default_rng(4)
    for _ in range(150):
        words = [f"w{i}" for i in rng.integers(0, rng.integers(1, 30), rng.integers(0, 120))]
        text = "".join(w + str(rng.choice([" ", "\n", "  "])) for w in words)
        assert hr.measure(text.encode()) == brute_measure(text)


def test_very_long_text():
    text = "one two three four five six seven " * 100_000
    assert hr.measure(text.encode())[4] == 700_000


GOOD = " ".join(f"word{i}" for i in range(40))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, 1, "h", "k") for d, t, s in rows], SCHEMA)


def test_host_verdicts_reach_documents(spark):
    rows = [(i, "bad", "http://User@Junk.example:80/x?y") for i in range(60)] + [(100, GOOD, "https://junk.example/z")]
    rows += [(200 + i, GOOD, f"src{i % 9}") for i in range(300)] + [(900 + i, "bad", f"src{i % 9}") for i in range(6)]
    rows += [(1000, GOOD, None), (None, GOOD, "src1"), (1001, None, None), (1002, GOOD, "lone"), (1003, "bad", "lone2"), (1004, GOOD, "lone2"),
             (1004, GOOD, "lone2")]
    got = hr.judge(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    hosts = {r.host: r.host_kept for r in got}
    assert hosts["junk.example"] is False and [h for h, ok in hosts.items() if not ok] == ["junk.example"]
    for r in got:
        assert r.base_failed == (r.n_words < 10) and r.kept == (not r.base_failed and r.host_kept)
    assert not next(r.kept for r in got if r.doc_id == 100)
    assert next(r.kept for r in got if r.doc_id == 1002) and next(r.kept for r in got if r.doc_id is None)
    assert hr.judge(frame(spark, rows).limit(0)).collect() == []


def test_small_hosts_are_shrunk_more(spark):
    rows = [(f"h{i}", i % 10 == 0) for i in range(200) for _ in range(20)] + [("small", True)] * 1 + [("large", True)] * 200
    df = spark.createDataFrame(rows, "host string, bad boolean")
    rate = {r.host: r.rate_bad for r in hr.host_verdicts(df, ["bad"]).collect()}
    assert rate["h1"] < rate["small"] < rate["large"] <= 1


def test_registered_query_equals_brute_force(spark):
    from obslake.llm.queries import op10_host_rules

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op10_host_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest, repeated, _ = brute_measure(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest, repeated)
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
