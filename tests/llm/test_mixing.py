import hashlib
import re

import pytest

from obslake.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size int, times int, rate double, `row` string"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target} of {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - cap * sum(sizes[s] for s in stopped)
        level = left / sum(weight[s] for s in free) if free and left > 0 else 0.0
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in stopped else weight[s] * level for s in order}
        stopped |= over


def brute_times(docs, seeds=mixing.SEEDS):
    sized = [(d, s, len(re.findall(mixing.WORD, t or "")), str(d) if d is not None
              else "text " + hashlib.md5((t or "").encode()).hexdigest()) for d, t, s in docs]
    sizes = {}
    for _, s, n, _ in sized:
        sizes[s] = sizes.get(s, 0) + n
    targets, times = brute_targets(sizes), {}
    for source, target in targets.items():
        rate = target / sizes[source] if sizes[source] else 0.0
        whole, part = int(rate), rate - int(rate)

        def taken(seed):
            return [(d, name, whole + (int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / 16**13 < part), n)
                    for d, s, n, name in sized if s == source]

        seed = min(range(seeds), key=lambda k: (abs(sum(t * n for *_, t, n in taken(k)) - target), k))
        times.update({name: t for _, name, t, _ in taken(seed)})
    return targets, {d if d is not None else name: times[name] for d, _, _, name in sized}


ROWS = [(i, "w " * (1 + i % 7), "big") for i in range(300)] + [(1000 + i, "x y", f"s{i % 5}") for i in range(40)] + [
    (2000, "", "empty"), (2001, None, "empty"), (2002, "a b c", None), (2003, "d " * 30_000, "Ähre"),
    (None, "no id", "s0"), (2004, "e", None)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(d, t, s, 1, 1, 0.5, "r") for d, t, s in rows], SCHEMA)


def test_equals_brute_force_and_reruns_agree(spark):
    targets, times = brute_times(ROWS)
    df = frame(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.target == pytest.approx(targets[r.row.source])
        name = "text " + hashlib.md5(r.row.text.encode()).hexdigest() if r.row.doc_id is None else r.row.doc_id
        assert r.times == times[name] and r.times <= 3
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted((r.row.doc_id or -1, r.times) for r in rows) == sorted((r.row.doc_id or -1, r.times) for r in again)


def test_targets_are_capped_and_share_the_total(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 20), ("d", 970), (None, 0)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert found["a"] == 30 and found[None] == 0
    assert sum(found.values()) == pytest.approx(2000)
    assert found == pytest.approx(brute_targets({"a": 10, "b": 1000, "c": 20, "d": 970, None: 0}))


def test_mixed_repeats_rows_and_keeps_columns(spark):
    df = frame(spark)
    _, times = brute_times(ROWS)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert out.count() == sum(times.values())
    assert mixing.mixed(df.limit(0)).collect() == [] and mixing.mix(df.limit(0)).collect() == []


def test_taken_is_near_the_target(spark):
    from pyspark.sql import functions as F

    rows = [(i, "w " * (1 + (i * i) % 50), f"s{i % 3}") for i in range(900)]
    out = mixing.mix(frame(spark, rows)).groupBy("row.source").agg(
        F.sum(F.col("times") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.02 * r.target for r in out)


def test_plan_has_no_python(spark):
    plan = mixing.mixed(frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
