"""Mixing sources to target weights, in Spark expressions only.

Sizes are words.  They are summed per source; every source gets a target
from its weight, stopped at ``max_repeats`` times its size, the excess going
to the others by weight.  The repetition rate of a source is target / size:
each of its documents is emitted floor(rate) times, and once more if a
hash-seeded Bernoulli draw with the rate's fraction as probability says so.

A few long documents make a plain draw miss the target, so ``seeds`` draws
are summed up per source in the same pass and the one whose total comes
nearest the target is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from obslake.llm.common import WORD, packed, written

WEIGHTS = (5, 2, 1)
SEEDS = 16
MAX_REPEATS = 3
DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _name(doc_id: Column, text: Column) -> Column:
    """What draws are seeded by: the id, the text's digest where it is null."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def _draws(name: Column, seeds: int) -> Column:
    """Uniform in [0, 1), one for each seed."""
    return F.transform(F.sequence(F.lit(0), F.lit(seeds - 1)), lambda k: F.conv(F.substring(
        F.md5(F.concat(k.cast("string"), F.lit(":"), name).cast("binary")), 1, DIGITS), 16, 10).cast("double")
        / float(16**DIGITS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` of a table of ``source, size``.

    Sources in code point order, null last, weigh ``weights``, repeating.
    Targets share the total by weight.  While some are above ``max_repeats``
    times their size, these stop there and the rest is shared anew: a loop
    over sums of the table of sources, of which each round is one row.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Ranks without one task for all: sorted ranges, each numbered by itself,
    # and the sizes of the ranges before (one row for each range).
    ranges = written(sources.withColumn("unnamed", F.col("source").isNull()).repartitionByRange("unnamed", "source")
                     .withColumn("range", F.spark_partition_id()), "mix-sources")
    before = ranges.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy("unnamed", "source")) - 1 + F.col("before")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = written(ranges.join(before, "range").select(
        "source", "source_size", F.get(cycle, (rank % len(weights)).cast("int")).alias("weight")), "mix-weights")

    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # the share of a unit of weight; it only grows as sources stop
    while True:
        stops = F.col("weight") * F.lit(level) > max_repeats * F.col("source_size")
        stopped, weight = ranked.agg(F.sum(F.when(stops, F.col("source_size"))),
                                     F.sum(F.when(~stops, F.col("weight")))).first()
        left = total - max_repeats * (stopped or 0)
        if not weight or left <= 0 or left / weight == level:
            break
        level = left / weight
    target = F.least((max_repeats * F.col("source_size")).cast("double"), F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                seeds: int = SEEDS) -> DataFrame:
    """One row per source: ``source, source_size, target, copies`` (how often
    each document is emitted for sure), ``fraction`` (the probability of one
    more) and ``seed`` (the draw to take)."""
    sizes = written(docs.select("source", word_count(F.col("text")).alias("size"),
                                _name(F.col("doc_id"), F.col("text")).alias("name")), "mix-sizes")
    targets = written(source_targets(sizes, weights, max_repeats), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = targets.withColumn("rate", rate).select(
        "*", F.floor("rate").alias("copies"), (F.col("rate") - F.floor("rate")).alias("fraction"))
    rates = rated.select(F.col("source").alias("s"), "copies", "fraction")
    drawn = sizes.filter("size > 0").join(rates, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "size", "copies", "fraction", _draws(F.col("name"), seeds).alias("u"))
    totals = drawn.groupBy("source").agg(*[
        F.sum(F.when(F.get("u", F.lit(k)) < F.col("fraction"), F.col("copies") + 1).otherwise(F.col("copies"))
              * F.col("size")).alias(f"t{k}") for k in range(seeds)])
    sums = totals.select(F.col("source").alias("s"), F.array(*[f"t{k}" for k in range(seeds)]).alias("totals"))
    missed = F.transform("totals", lambda t, k: F.struct(F.abs(t - F.col("target")).alias("by"), k.alias("seed")))
    return rated.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "copies", "fraction",
        F.coalesce(F.array_min(missed)["seed"], F.lit(0)).alias("seed"))


def _with_plan(docs: DataFrame, plan: DataFrame, seeds: int) -> DataFrame:
    rows = docs.select(packed(docs), F.col("source").alias("of"), word_count(F.col("text")).alias("size"),
                       _draws(_name(F.col("doc_id"), F.col("text")), seeds).alias("u"))
    joined = rows.join(plan, F.col("of").eqNullSafe(F.col("source")))
    copies = F.col("copies") + (F.get("u", F.col("seed")) < F.col("fraction")).cast("bigint")
    return joined.select("row", "size", "source_size", "target", copies.alias("times"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        seeds: int = SEEDS) -> DataFrame:
    """``row`` (all columns of ``docs``), ``size``, ``source_size``,
    ``target`` (of its source) and ``times`` (how often the mix takes the
    document), one row per row of ``docs``.

    Null and empty texts have size 0.  A source of size 0 has target 0 and
    its documents are not taken.  The null source is a source, the last one.
    Rows that repeat an id take the same draw; a null id is replaced by the
    text.  An empty table gives no rows.  Reruns agree.
    """
    plan = written(mixing_plan(docs, weights, max_repeats, seeds), "mix-plan")
    return _with_plan(docs, plan, seeds)


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as it is
    taken (see :func:`mix`; rows without a word take their source's rate and
    draw like others, unless the whole source has none)."""
    taken = mix(docs, **kw).filter("times > 0")
    copies = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
