"""Connected components of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logmetrics.functions.staging import stage


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex goes to the least of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    up = both.filter("v > u").join(least, "u")
    return up.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its neighbours below it go to the least of these. Edges run downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``v`` and ``c``, the least vertex reachable, for every vertex on a link that is not the least itself.

    Alternating large and small stars, each round written to the shared folder;
    rounds grow with the logarithm of the longest path. Nothing but an edge count
    and a checksum comes to the driver. Links to itself and null ends do not count.
    No links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    edges = stage(edges.distinct(), "components")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("v"), F.col("v").alias("c"))
