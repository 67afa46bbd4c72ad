"""Merkle manifest of a document table by sibling-shift self-joins.

Every document is a leaf; the leaves of a source, ascending by doc_id, are
the bottom level of that source's tree, and the source roots, ordered by
source, are the bottom level of the tree that gives the one root.

A level is a table of numbered nodes.  One step up: every node in slot zero
computes the indices of its siblings (its own index XOR 1 in a binary tree,
its index plus the slot offsets otherwise), equijoins the level with them, and
emits the parent.  Keys are (tree, index), so a source that holds most rows is
spread like any other.  Proofs go the other way: from the root down each run
of siblings is joined with the path of its parent, so a path is shuffled once
for a run and not once for a node.

Texts never move: leaves are digested where they are read, and only digests
and ids are shuffled.  Indices come from a range partitioning: rows are
numbered inside their partition, and (partition, source) counts, a table of
about as many rows as there are partitions and sources, give the offsets.
Each level is a written table, so a lost executor costs one level at most.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """Lowercase hex sha256."""
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf: UTF-8 byte count, ``:``, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: dict[str, Column]) -> Column:
    return digest(F.concat(*[field(values[name]) for name in FIELDS]))


def numbered(rows: DataFrame, group: str | None, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` sorted by group and ``order``, written with ``row`` (partition
    and place in it), and the runs: for every partition and group the first
    ``row``, how many there are and how many the group has before."""
    keys = [group] if group else []
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = written(ranged.withColumn("row", F.monotonically_increasing_id())
                     .withColumn("part", F.shiftright("row", 33)), name)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("part", *keys).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("held"))
    return placed, runs.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))


def sibling_indices(at: Column, n: Column, fanout: int) -> Column:
    """Indices of the siblings of a slot-zero node in a level of ``n`` nodes."""
    if fanout == 2:
        other = at.bitwiseXOR(F.lit(1))
        return F.when(other < n, F.array(other)).otherwise(F.array().cast("array<bigint>"))
    last = F.least(F.lit(fanout - 1).cast("bigint"), n - at - 1)
    offsets = F.when(last > 0, F.sequence(F.lit(1).cast("bigint"), last))
    return F.transform(offsets, lambda o: at + o)


def level_up(nodes: DataFrame, fanout: int) -> DataFrame:
    """Runs of siblings of a level (``tree, n, at, digest``; trees of one node
    have none): ``tree, n, at`` of the parent, ``members`` (the digests of the
    run in order) and the parent's ``digest``."""
    at, n = F.col("at"), F.col("n")
    zero = nodes.filter((n > 1) & (at % fanout == 0)).select(
        "tree", "n", F.col("at").alias("first"), F.col("digest").alias("own"),
        F.explode_outer(sibling_indices(at, n, fanout)).alias("at"))
    joined = zero.join(nodes.select("tree", "at", "digest"), ["tree", "at"], "left")
    found = F.collect_list(F.when(F.col("digest").isNotNull(), F.struct("at", "digest")))
    runs = joined.groupBy("tree", "n", "first", "own").agg(F.array_sort(found).alias("found"))
    members = F.concat(F.array("own"), F.transform("found", lambda s: s["digest"]))
    return runs.select(
        "tree", F.ceil(F.col("n") / fanout).cast("bigint").alias("n"), (F.col("first") / fanout).cast("bigint").alias("at"),
        members.alias("members")).withColumn("digest", digest(F.array_join("members", "")))


def grow(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of the trees in ``nodes``, lowest first (tables of
    :func:`level_up`), and ``tree, level, digest`` of what remains of each."""
    levels: list[DataFrame] = []
    tops = [nodes.filter("n = 1").select("tree", F.lit(0).alias("level"), "digest")]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        runs = written(level_up(nodes, fanout), "level")
        levels.append(runs)
        nodes = runs.select("tree", "n", "at", "digest")
        tops.append(nodes.filter("n = 1").select("tree", F.lit(len(levels)).alias("level"), "digest"))
        most = -(-most // fanout)
    return levels, reduce(DataFrame.unionByName, tops)


PATH = "array<struct<left:string,right:string>>"


def step(members: Column, slot: Column) -> Column:
    """The digests before and after a slot, each side as one text."""
    length = F.size(members)
    return F.struct(
        F.array_join(F.slice(members, F.lit(1), slot), "").alias("left"),
        F.array_join(F.slice(members, slot + 2, F.greatest(length - slot - 1, F.lit(0))), "").alias("right"))


def descend(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``tree, at, members, subroot, path`` for every run of the lowest level,
    where ``path`` leads from the run's parent to the root; ``tops`` has
    ``tree, level, subroot, path`` of the trees' own roots.  A tree of one leaf
    is a run without members."""
    def of_level(level: int) -> DataFrame:
        return tops.filter(F.col("level") == level).select("tree", F.lit(0).cast("bigint").alias("at"), "subroot", "path")

    above = of_level(len(levels))
    for level in range(len(levels) - 1, -1, -1):
        runs = levels[level].select("tree", "at", "members").join(above, ["tree", "at"])
        if level == 0:
            alone = of_level(0).withColumn("members", F.lit(None).cast("array<string>"))
            return runs.unionByName(alone)
        nodes = runs.select(
            "tree", F.col("at").alias("run"), "members", "subroot", "path",
            F.posexplode("members").alias("slot", "_")).select(
            "tree", (F.col("run") * fanout + F.col("slot")).alias("at"), "subroot",
            F.concat(F.array(step(F.col("members"), F.col("slot"))), F.col("path")).alias("path"))
        above = nodes.unionByName(of_level(level))
    return above.withColumn("members", F.lit(None).cast("array<string>"))


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, n, at, doc_id, source, leaf, claimed; ``levels`` and
    ``subroots`` (source, tree, level, subroot) of the source trees;
    ``root_levels`` of the tree over them; ``root`` (null without rows)."""

    fanout: int
    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    root_levels: list[DataFrame]
    root: str | None

    def nodes(self) -> DataFrame:
        """Every node as a row: ``source`` (null in the tree over the
        sources, and for the null source), ``level`` (the leaves are 0, the
        tree over the sources counts from -1 downwards), ``at``, ``digest``."""
        names = self.subroots.select("tree", "source")
        low = [self.leaves.select("tree", F.lit(0).alias("level"), "at", F.col("leaf").alias("digest"))]
        low += [x.select("tree", F.lit(i + 1).alias("level"), "at", "digest") for i, x in enumerate(self.levels)]
        of_sources = reduce(DataFrame.unionByName, low).join(names, "tree").drop("tree")
        top = [x.select(F.lit(-1 - i).alias("level"), "at", "digest", F.lit(None).cast("string").alias("source"))
               for i, x in enumerate(self.root_levels)]
        return reduce(DataFrame.unionByName, [of_sources, *top])

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, claimed, subroot, path`` for every leaf: the path
        holds, level by level to the root, the siblings left and right."""
        root = self.subroots.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(0).cast("bigint").alias("tree"), F.lit(len(self.root_levels)).alias("level"),
            F.lit(self.root).alias("subroot"), F.array().cast(PATH).alias("path"))
        over = descend(self.root_levels, root, self.fanout)
        slot = (F.col("tree") % self.fanout).cast("int")
        up = over.select((F.col("at") * 1).alias("run"), F.col("members").alias("of_run"), F.col("path").alias("up"))
        tops = self.subroots.withColumn("run", F.expr(f"tree div {self.fanout}")).join(up, "run").select(
            "tree", "level", "subroot",
            F.when(F.col("of_run").isNull(), F.col("up")).otherwise(
                F.concat(F.array(step(F.col("of_run"), slot)), F.col("up"))).alias("path"))
        runs = descend(self.levels, written(tops, "source-paths"), self.fanout).select(
            "tree", F.col("at").alias("run"), "members", "subroot", "path")
        own = (F.col("at") % self.fanout).cast("int")
        return self.leaves.withColumn("run", F.expr(f"at div {self.fanout}")).join(runs, ["tree", "run"]).select(
            "doc_id", "leaf", "claimed", "subroot",
            F.when(F.col("members").isNull(), F.col("path")).otherwise(
                F.concat(F.array(step(F.col("members"), own)), F.col("path"))).alias("path"))

    def verified(self) -> DataFrame:
        """The proofs checked: ``doc_id, leaf, subroot, root, proof_sha256``
        (digest of the siblings, level by level, left to right), ``folded_root``
        (from the claimed leaf and the siblings) and ``verified``."""
        siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
        folded = F.aggregate("path", F.col("claimed"), lambda d, s: digest(F.concat(s["left"], d, s["right"])))
        root = F.lit(self.root).cast("string")
        return self.proofs().select(
            "doc_id", "leaf", "subroot", root.alias("root"), digest(siblings).alias("proof_sha256"),
            folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == root)


def build(docs: DataFrame, fanout: int = 16, claimed_text: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    ``claimed_text`` is the text as somebody else has it; the leaf digested
    from it (``claimed``) is what :meth:`Manifest.verified` folds.  Default:
    the text itself.

    Nulls: any field (``-`` in the leaf, so null and empty differ); a null
    source is a source of its own, ordered first; null doc_ids come first in
    their source.  Rows with one doc_id are ordered by leaf; fully equal rows
    are a leaf each.  Very long texts are digested in place.  Empty table: no
    rows and a null root.  Other columns are ignored.
    """
    if fanout < 2:
        raise ValueError("fanout is 2 or more")
    values = {c: F.col(c) for c in FIELDS}
    claimed = values if claimed_text is None else {**values, "text": claimed_text}
    # Null sources sort first and equal each other in joins.
    named = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))
    digested = written(docs.select(
        "doc_id", named.alias("named"), leaf_digest(values).alias("leaf"), leaf_digest(claimed).alias("claimed"),
        F.monotonically_increasing_id().alias("tie")), "leaves")
    placed, runs = numbered(digested, "named", ["doc_id", "leaf", "tie"], "ordered-leaves")

    counted = runs.groupBy("named").agg(F.sum("held").alias("n"))
    ordered, parts = numbered(counted, None, ["named"], "ordered-sources")
    trees = written(ordered.join(parts, "part").select(
        "named", "n", (F.col("row") - F.col("first") + F.col("before")).alias("tree")), "trees")
    offsets = written(runs.join(trees, "named"), "offsets")
    source = F.when(F.col("named") != "0", F.substring("named", 2, 2**31 - 1))
    leaves = written(placed.join(offsets, ["part", "named"]).select(
        "tree", "n", (F.col("row") - F.col("first") + F.col("before")).alias("at"), "doc_id",
        source.alias("source"), "leaf", "claimed"), "placed-leaves")

    levels, tops = grow(leaves.select("tree", "n", "at", F.col("leaf").alias("digest")), fanout)
    subroots = written(tops.join(trees, "tree").select(
        source.alias("source"), "tree", "level", F.col("digest").alias("subroot")), "subroots")
    n_sources = subroots.count()
    root_levels, top = grow(subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.lit(n_sources).cast("bigint").alias("n"),
        F.col("tree").alias("at"), F.col("subroot").alias("digest")), fanout)
    root = top.first()
    return Manifest(fanout, leaves, levels, subroots, root_levels, root["digest"] if root else None)
