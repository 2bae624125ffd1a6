"""Connected components of an undirected graph given as pairs of longs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.session import stored


def _flat(parents: DataFrame) -> DataFrame:
    """(node, parent) with parent < node, pointed at the root of each tree.

    Every pass halves the depth, so passes are logarithmic in the longest chain."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents = stored(
            parents.join(up, "parent", "left").select(
                "node",
                F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "parents",
        )
        if not parents.where("moved").limit(1).count():
            return parents.select("node", "parent")


def _lowered(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reached.

    Each round hooks every node that has a smaller neighbour on the smallest one, flattens
    the trees and contracts the edges. A node that stays a root has only larger neighbours,
    all of which were hooked, so the nodes in play at least halve. Nulls and loops are ignored;
    an empty input gives an empty result. Each round is cut by a written table."""
    edges = stored(_lowered(edges), "edges")
    roots = None
    while edges.limit(1).count():
        hooked = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent"))
        flat = _flat(stored(hooked, "hooked"))
        if roots is None:
            nodes = edges.select(F.col("lo").alias("node")).unionByName(
                edges.select(F.col("hi").alias("node"))
            )
            roots = nodes.distinct().select("node", F.col("node").alias("root"))
        step = flat.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        roots = stored(
            roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
            "roots",
        )
        a = flat.select(F.col("node").alias("hi"), F.col("parent").alias("a"))
        b = flat.select(F.col("node").alias("lo"), F.col("parent").alias("b"))
        contracted = (
            edges.join(a, "hi", "left")
            .join(b, "lo", "left")
            .select(F.coalesce("a", "hi").alias("a"), F.coalesce("b", "lo").alias("b"))
        )
        edges = stored(_lowered(contracted), "edges")
    if roots is None:
        roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots
