"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import discard, staged


def _starred(links: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours above it (or up to it) linked to its smallest neighbour instead.

    The join key is a hash of the grouping key, so that both sides are shuffled and a node with
    very many neighbours can be split.
    """
    if large:
        links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(
        F.xxhash64("a").alias("meet"), F.col("a").alias("node"), F.least("a", "least").alias("least")
    )
    met = links.withColumn("meet", F.xxhash64("a")).join(least, "meet").where("a = node")
    if large:
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        pair = F.array(F.col("a"), F.col("b"))
        moved = met.select(F.explode(pair).alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, its component's smallest node, for every node of a link but roots.

    ``links`` has two columns of numbers, ``a`` and ``b``.  Large and small stars alternate until
    the links no longer change, which takes about as many rounds as a component's diameter has
    binary digits; each round is written to the shared folder.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(now.where("a > b").distinct(), "links")
    mark = F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("sum")
    seen = now.agg(*mark).first()
    while seen.n:
        before, now = now, staged(_starred(_starred(now, True), False), "links")
        discard(before)
        found = now.agg(*mark).first()
        if found == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
