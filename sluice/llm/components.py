"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` with the smaller of ``a`` and the least of its ``b`` as ``least``."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(least.hint("merge"), "a").withColumn("least", F.least("a", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's greater neighbours are linked to its least neighbour or itself."""
    return _with_least(_both_ways(links)).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    known = _with_least(down)
    return (
        known.select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(known.select("a", F.col("least").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links`` (``a``, ``b``): the least node that it can reach.

    Large and small stars take turns until nothing changes, which takes about as many turns as the logarithm
    of the number of nodes. Every step is a grouping with partial sums and a join on its key.
    """
    links = written(links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        links = written(_small_star(written(_large_star(links))))
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
