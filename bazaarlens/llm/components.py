"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import written

MOST_ROUNDS = 100


def _towards_least(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least of its neighbourhood."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _up(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")))
    tied = links.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether each larger node has one neighbour, which has no smaller one: then that is the least of their component."""
    ends = links.select("a", F.lit(1).alias("n")).union(links.select("b", F.lit(0)).distinct())
    counted = ends.groupBy("a").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    return counted.where("n > 1 or (n = 1 and least = 0)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; the root is the least node of its component.

    Neighbours are tied to the least of them, by turns from either end, until every
    component is a star; this takes a few rounds even for long chains. A node with
    many links is one key of a join and of a sum, never a gathered list; the sums are
    written, so that the joins deal both sides anew and can split such a key. Links with a
    null end and links of a node to itself are left out.
    """
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col("a") > F.col("b")).distinct()
    links = written(links)
    for _ in range(MOST_ROUNDS):
        if _stars(links):
            break
        links = written(_up(_towards_least(links)))
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
