"""Sums over the subtrees of a tree by centroid decomposition."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import written

#: Components of so many nodes are decomposed inside a task, larger ones by joins.
LOCAL = 4096
#: Every round halves the weight of each component, so this is never reached.
MOST_ROUNDS = 64


def centroid_sums(parents: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sum of each node's subtree, for every list of ``values``.

    ``parents`` has each node's parent (-1 without one), parents before children. A
    component is split at its centroid, below which no piece holds more than half of it; what lies
    at and below the centroid is added to the nodes from there to the component's top.
    """
    up, sums = list(parents), [list(own) for own in values]
    pending = [part for part in _pieces(range(len(up)), up).values()]
    size = [1] * len(up)
    while pending:
        part = pending.pop()
        if len(part) == 1:
            continue
        for v in part:
            size[v] = 1
        for v in reversed(part):
            if up[v] >= 0:
                size[up[v]] += size[v]
        centre = next(v for v in reversed(part) if 2 * size[v] > len(part))
        path, v = [], up[centre]
        while v >= 0:
            path.append(v)
            v = up[v]
        below = [v for v in part if up[v] == centre]
        for v in (centre, *below):
            up[v] = -1
        pieces = _pieces((v for v in part if v != centre), up)
        for own, total in zip(values, sums):
            under = sum(own[v] for top in below for v in pieces[top])
            total[centre] += under
            for v in path:
                total[v] += under + own[centre]
        pending += pieces.values()
    return sums


def _pieces(nodes, up: list[int]) -> dict[int, list[int]]:
    """Nodes by the top that they hang from."""
    top: dict[int, int] = {}
    out: dict[int, list[int]] = {}
    for v in nodes:
        top[v] = v if up[v] < 0 else top[up[v]]
        out.setdefault(top[v], []).append(v)
    return out


def _local(names: list[str]):
    def output(held: list[dict]) -> pa.RecordBatch:
        place = {row["node"]: k for k, row in enumerate(held)}
        sums = centroid_sums([place.get(row["parent"], -1) for row in held], [[row[c] for row in held] for c in names])
        added = [pa.array([row[f"{c}_sum"] - row[c] + s for row, s in zip(held, own)], pa.int64()) for c, own in zip(names, sums)]
        return pa.RecordBatch.from_arrays([pa.array([row["node"] for row in held], pa.binary()), *added], names=["node", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in in_pieces(batches):
            for row in batch.to_pylist():
                if held and held[0]["piece"] != row["piece"]:
                    yield output(held)
                    held = []
                held.append(row)
        if held:
            yield output(held)

    return run


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """(node, *values): the sum of each value (bigint) over the node and all below it.

    ``nodes`` are those of one tree: node, parent (null at the top), depth, ``path`` (any path through the node), ``weight``
    (sum over the subtree of positive numbers) and the values; ``paths`` has path, depth, node and parent
    of every path's steps below the top. Each round splits all components of more than
    ``local`` nodes at their weighted centroids: the deepest node with over half of the weight. Nodes
    above it are those through which a path of the centroid leads; nodes below find their new component's top on their
    own path, one step under the centroid. Sums of a component are one row; nodes above receive them, and lose the centroid's
    weight. So every round halves the weights, whatever the depth of the tree, and no component is gathered that
    is larger than ``local``.
    """
    sums = [f"{c}_sum" for c in values]
    pieces = nodes.select("node", "parent", "depth", "path", "weight", *values, *[F.col(c).alias(s) for c, s in zip(values, sums)], F.substring("node", 1, 0).alias("piece"))
    done: list[DataFrame] = []
    small: list[DataFrame] = []
    at = paths.select(F.col("path").alias("own_path"), F.col("depth").alias("own_depth"), F.col("node").alias("below"), F.col("parent").alias("under"))
    through = paths.select(F.col("node").alias("own_node"), F.col("path").alias("through"), F.lit(True).alias("above"))
    for _ in range(MOST_ROUNDS):
        sizes = written(pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("whole")))
        placed = written(pieces.join(sizes, "piece"))
        small.append(placed.where(F.col("n") <= local).drop("n", "whole"))
        large = placed.where(F.col("n") > local)
        if not sizes.where(F.col("n") > local).limit(1).count():
            break
        heavy = large.where(2 * F.col("weight") > F.col("whole"))
        centre = written(heavy.groupBy("piece").agg(F.max(F.struct("depth", "node", "path", "weight")).alias("c")))
        large = large.join(centre, "piece").select(
            *large.columns, F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"), F.col("c.path").alias("c_path"), F.col("c.weight").alias("c_weight")
        )
        on_path = (F.col("own_path") == F.col("path")) & (F.col("own_depth") == F.col("c_depth") + 1) & (F.col("under") == F.col("c_node"))
        marked = large.join(at, on_path & (F.col("depth") > F.col("c_depth")), "left").drop("own_path", "own_depth", "under")
        over = (F.col("node") == F.col("own_node")) & (F.col("c_path") == F.col("through")) & (F.col("depth") < F.col("c_depth"))
        marked = written(marked.join(through, over, "left").select(*marked.columns, F.coalesce("above", F.col("parent").isNull() & (F.col("depth") < F.col("c_depth"))).alias("above")))
        middle = F.col("node") == F.col("c_node")
        totals = marked.where(middle | F.col("below").isNotNull()).groupBy("piece").agg(*[F.sum(c).alias(f"{c}_under") for c in values])
        totals = written(totals)
        added = [
            (F.col(s) + F.when(middle, F.col(f"{c}_under") - F.col(c)).when(F.col("above"), F.col(f"{c}_under")).otherwise(0)).alias(s)
            for c, s in zip(values, sums)
        ]
        split = marked.join(totals, "piece").select(
            "node", "parent", "depth", "path", *values, *added, middle.alias("middle"),
            F.when(F.col("above"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            F.coalesce("below", "piece").alias("piece"),
        )
        split = written(split)
        done.append(split.where("middle").select("node", *[F.col(s).alias(c) for c, s in zip(values, sums)]))
        pieces = split.where("not middle").drop("middle")
    else:
        raise RuntimeError("components did not shrink")
    rest = reduce(DataFrame.unionByName, small).repartition("piece").sortWithinPartitions("piece", "depth")
    schema = "node binary, " + ", ".join(f"{c} bigint" for c in values)
    return reduce(DataFrame.union, done, in_tasks(rest, _local(values), schema))
