"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import save


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``edges(a, b)`` but the roots themselves: root is
    the least vertex of v's component.

    Each round hangs neighbours on the least neighbour (large star), then a vertex's
    smaller neighbours on the least of them (small star); the edge list never grows beyond
    its first size by more than the vertices and becomes one star a component after about
    log(vertices) rounds.  A vertex's least neighbour is aggregated map-side and written
    before it is joined, so that both join sides are exchanges that Spark can split where a
    hub has very many edges.  Nothing but two sums a round reaches the driver.  Null ends
    and loops are ignored; an empty edge list gives an empty result.
    """
    e = save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = save(both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .distinct(), "large")
        least = save(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        e = save(
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())
        if now == mark:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        mark = now
