"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (node, component): the smallest node that each linked node reaches.

    Rounds of large stars and small stars: every node hands its neighbours to the smallest one it knows, which takes
    a number of rounds that grows with the logarithm of the longest path. Smallest neighbours come from partial
    aggregates, and a node with very many links is split by the skew join. Each round is written and read back.
    Nulls and links of a node with itself don't count.
    """
    pairs = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = stored(
        pairs.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
