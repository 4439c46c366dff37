"""Connected components of a link table, by contraction.

Each round every node points to its least neighbour (or itself), pointers are
followed to their roots by doubling, and the links are drawn anew between roots.
Every component that still has links loses at least half of its nodes a round. A
node with many neighbours costs a partial aggregate and joins that adaptive
execution can split; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch


def connected_components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the least node reachable.

    Links may repeat, in either direction, and loops are ignored; nodes that only
    have loops are left out. No links give an empty table.
    """
    links = scratch.save(links.select("a", "b").filter("a <> b").distinct(), f"{name}-links-0")
    roots, level = None, 0
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
        hop = scratch.save(least, f"{name}-hop-{level}-0")
        jump = 0
        while True:
            to = hop.select(F.col("node").alias("root"), F.col("root").alias("further"))
            step = hop.join(to, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved"))
            jump += 1
            step = scratch.save(step, f"{name}-hop-{level}-{jump}")
            scratch.drop(f"{name}-hop-{level}-{jump - 1}")
            moved = not step.filter("moved").isEmpty()
            hop = step.drop("moved")
            if not moved:
                break
        if roots is None:
            roots = hop
        else:
            to = hop.select(F.col("node").alias("root"), F.col("root").alias("further"))
            roots = roots.join(to, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
        roots = scratch.save(roots, f"{name}-roots-{level}")
        left = links.join(hop.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        left = left.join(hop.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        left = left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a <> b")
        level += 1
        links = scratch.save(left.distinct(), f"{name}-links-{level}")
        scratch.drop(f"{name}-links-{level - 1}", f"{name}-roots-{level - 2}", f"{name}-hop-{level - 1}-{jump}")
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
