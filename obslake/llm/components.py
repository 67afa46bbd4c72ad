"""Connected components of a graph of long ids, by contraction.

Each round lets every node point at its smallest neighbour (if smaller than
itself), shortens the pointers to the roots by doubling, and goes on with
the edges between roots.  A node with an edge ends up under a root with
another node, so nodes at least halve each round.  Only (node, root) rows
move; nothing is collected, and every round is a written table.  Hubs: the
smallest neighbour is a partial aggregate, and the joins are of plain tables,
whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import written


def _roots(pointers: DataFrame) -> DataFrame:
    """(node, root) from (node, root) where every root is a node: follow the
    pointers to their ends, twice as far each time."""
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("up"))
        further = written(pointers.join(up, "root").select("node", F.col("up").alias("root"),
                                                           (F.col("up") != F.col("root")).alias("moved")), "roots", narrow=True)
        pointers = further.select("node", "root")
        if further.filter("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b, bigint):
    nodes are connected exactly if their roots are equal; a root is a node of
    its component.  Loops and repeated edges are harmless, edges with a null
    are no edges.  No edges: no rows."""
    edges = written(edges.select("a", "b").filter("a != b").distinct(), "edges", narrow=True)
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        pointers = written(smallest.select("node", F.least("node", "least").alias("root")), "pointers", narrow=True)
        roots = _roots(pointers)
        if found is None:
            found = roots
        else:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
            found = written(found.join(up, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")), "found", narrow=True)
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(a, "a").join(b, "b").filter("ra != rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges", narrow=True)
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
