"""Connected components of a link table, as joins and partial aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import materialize, release, sized


def _jump(parents: DataFrame) -> DataFrame:
    """Follow parents to the roots, doubling the reach each time."""
    while True:
        up = parents.select(F.col("node").alias("p"), F.col("parent").alias("next"))
        moved = parents.join(sized(up), parents["parent"] == up["p"], "left")
        step = materialize(moved.select("node", F.coalesce("next", "parent").alias("parent"), (F.col("next") != F.col("parent")).alias("m")), "cc-jump")
        left = step.filter("m").limit(1).count()
        release(parents)
        parents, at = step.select("node", "parent"), step._marlstone_path
        parents._marlstone_path = at
        if not left:
            return parents


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is one node of its component, the same for all of it.

    Every node takes its smallest neighbour, or itself, as parent; parents are followed to the roots; links between roots
    remain, and the same is done with them until none is left. Each round at least halves the roots that still have links.
    """
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct(), "cc-edges")
    found = None
    while found is None or edges.limit(1).count():
        both = edges.union(edges.select("v", "u"))
        near = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        parents = _jump(materialize(near.select("node", F.least("node", "low").alias("parent")), "cc-parents"))
        to = parents.select(F.col("node").alias("n"), F.col("parent").alias("r"))
        if found is None:
            found = parents.select("node", F.col("parent").alias("root"))
            found._marlstone_path = parents._marlstone_path
        else:
            old = found
            found = materialize(old.join(sized(to), old["root"] == to["n"], "left").select("node", F.coalesce("r", "root").alias("root")), "cc-found")
            release(old)
        side = sized(to)
        left = edges.join(side, edges["u"] == side["n"], "left").select(F.coalesce("r", "u").alias("u"), "v")
        both_ends = left.join(side, left["v"] == side["n"], "left").select("u", F.coalesce("r", "v").alias("v"))
        rest = materialize(both_ends.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-edges")
        release(edges)
        edges = rest
    return found
