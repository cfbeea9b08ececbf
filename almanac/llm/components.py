"""Connected components of a link table, by contracting links round by round.

Each round sends every neighbour of a node to the node's smallest neighbour: first the larger ones (large star),
then the smaller ones (small star). Both keep connectivity, and after a logarithmic number of rounds every link
points to the smallest node of its component. A node may have any number of neighbours: only minima are gathered
per node, by aggregation and join, never lists. Each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) in both directions; every neighbour b on the wanted side of a is linked to a's least neighbour."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    side = F.col("b") > F.col("a") if large else F.col("b") <= F.col("a")
    moved = links.filter(side).join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    if not large:
        moved = moved.union(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
    return moved.filter("x != y").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for all linked nodes; component is the smallest node reachable. Nodes need an order."""
    both = lambda t, x, y: t.select(F.col(x).alias("a"), F.col(y).alias("b")).union(
        t.select(F.col(y).alias("a"), F.col(x).alias("b"))
    )
    now = stored(links.select(F.least(a, b).alias("y"), F.greatest(a, b).alias("x")).filter("x != y").distinct(), "links")
    mark = None
    while not now.isEmpty():
        grown = _star(both(now, "x", "y"), large=True)
        now = stored(_star(both(grown, "x", "y"), large=False), "links")
        total = now.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if tuple(total) == mark:
            break
        mark = tuple(total)
    roots = now.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).union(roots)
