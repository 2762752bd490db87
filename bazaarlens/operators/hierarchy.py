"""Walk of a parent/child edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.session import cut_lineage


def walk_tree(edges: DataFrame) -> DataFrame:
    """Every node reachable from a root, as ``(node, parent, level, root)``.

    ``edges`` has ``node`` and ``parent``; a root has no parent. Each round doubles how far up
    every node looks, so a tree of any depth takes the logarithm of its depth in
    rounds. A node with two parents is no tree (below a root, that is the only way into a cycle)
    and raises. Nodes that no root leads to, such as those of a cycle of its own, are never reached.
    """
    edges = cut_lineage(edges.select("node", "parent").distinct())
    twice = edges.groupBy("node").count().filter("count > 1").first()
    if twice is not None:
        raise ValueError(f"not a tree: node {twice[0]!r} has {twice[1]} parents, or lies on a cycle")
    top = F.coalesce("parent", "node").alias("top")
    done = edges.select("node", "parent", top, F.col("parent").isNotNull().cast("int").alias("level"), F.col("parent").isNull().alias("done"))
    done, reached = cut_lineage(done), -1
    while (found := done.filter("done").count()) != reached:
        reached = found
        above = done.select(F.col("node").alias("top"), F.col("top").alias("next"), F.col("level").alias("steps"), F.col("done").alias("ends"))
        further = done.filter("not done").join(above, "top").select(
            "node", "parent", F.col("next").alias("top"), (F.col("level") + F.col("steps")).alias("level"), F.col("ends").alias("done")
        )
        done = cut_lineage(done.filter("done").union(further))
    return done.filter("done").select("node", "parent", "level", F.col("top").alias("root"))
