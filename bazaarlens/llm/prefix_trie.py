"""The trie of shared beginnings of conversations, with totals of every subtree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.centroids import LOCAL, subtree_sums
from bazaarlens.llm.running import START, as_key, in_ranges, prefixes
from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import cut_lineage

#: Ids of a list that are joined in one row.
CHUNK = 4096
#: Every conversation takes its first turns, up to ``HEADS - 1``, from the first of ``FAMILY`` neighbours.
FAMILY, HEADS = 5, 9


def turn_items(conversations: DataFrame, id_column: str = "conv_id", order_column: str = "turn") -> DataFrame:
    """key, turn, item and bytes of every turn: a digest of role and text, and the size of the text.

    A null role or text is empty. Rows without an id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("key"),
        F.col(order_column).alias("turn"),
        F.unhex(F.md5(whole.cast("binary"))).alias("item"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def _borrowed(key: Column) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % HEADS).cast("bigint")


def rebuilt(items: DataFrame) -> DataFrame:
    """key, part, place, item, bytes: each conversation with its first turns taken from its family's first.

    Conversation c has the first h turns of c - c % FAMILY (all, if there are fewer), then its own
    turns after its first h; h is the CRC-32 of c in decimal modulo HEADS. Turns are ordered by ``turn``, null first, equal ones by digest.
    """
    numbered = cut_lineage(prefixes(items.withColumn("own", F.col("item")), "turn", "item").select("key", "depth", F.col("own").alias("item"), "bytes"))
    own = numbered.where(F.col("depth") > _borrowed(F.col("key"))).select("key", F.lit(1).alias("part"), F.col("depth").alias("place"), "item", "bytes")
    first = numbered.where((F.col("key") % FAMILY == 0) & (F.col("depth") < HEADS))
    # The sign of a remainder follows the number, so those around 0 all belong to it.
    low = F.when(F.col("key") > 0, F.col("key")).otherwise(F.col("key") - (FAMILY - 1))
    high = F.when(F.col("key") < 0, F.col("key")).otherwise(F.col("key") + (FAMILY - 1))
    dealt = first.withColumn("c", F.explode(F.sequence(low, high))).where(F.col("depth") <= _borrowed(F.col("c")))
    known = numbered.select(F.col("key").alias("c")).distinct()
    heads = dealt.join(known, "c", "left_semi").select(F.col("c").alias("key"), F.lit(0).alias("part"), F.col("depth").alias("place"), "item", "bytes")
    return heads.union(own)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of ids as text, in rows of ``CHUNK`` ids at most."""
    node, ids = None, []

    def output(done: list[tuple]) -> pa.RecordBatch:
        nodes, first, text = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(first, pa.int64()), pa.array(text, pa.binary())], names=["node", "first", "text"])

    for batch in in_pieces(batches):
        done = []
        for own, key in zip(batch.column("node").to_pylist(), batch.column("key").to_pylist()):
            if ids and (own != node or len(ids) == CHUNK):
                done.append((node, ids[0], ",".join(map(str, ids)).encode()))
                ids = []
            node = own
            ids.append(key)
        if done:
            yield output(done)
    if ids:
        yield output([(node, ids[0], ",".join(map(str, ids)).encode())])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each list, of which one row at a time is held."""
    node, digest = None, None

    def output(nodes: list[bytes], digests: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])

    for batch in in_pieces(batches):
        nodes, digests = [], []
        for own, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
            if own == node:
                digest.update(b",")
            else:
                if node is not None:
                    nodes.append(node)
                    digests.append(digest.hexdigest())
                node, digest = own, hashlib.sha256()
            digest.update(text)
        yield output(nodes, digests)
    if node is not None:
        yield output([node], [digest.hexdigest()])


def list_digests(members: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of each node's ``key`` values in order, joined by commas.

    Ids are joined to long rows range by range first, so that a node with very many sends few rows.
    """
    lists = in_tasks(in_ranges(members.select("node", "key"), "node", "key"), _joined, "node binary, first bigint, text binary")
    return in_tasks(lists.repartition("node").sortWithinPartitions("node", "first"), _digested, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, *order: str, local: int = LOCAL) -> DataFrame:
    """One row for each distinct beginning of the conversations, the empty one included.

    ``turns`` has key, item, bytes and the columns of ``order``; ``conversations`` the keys of all, those
    without turns too. Result: ``conv_id`` (least key that begins so), ``depth`` (turns), ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (both over the subtree: nodes without
    children; bytes of each node's last text for all but one of its conversations), ``ends_sha256`` (of the keys that end here).

    Beginnings are digests carried along each conversation. Totals of subtrees come from a centroid
    decomposition, whose weights (turns at and below a node) are sums over the turns that pass it. A conversation or a beginning of very many rows is
    a key of joins and sums only. Without conversations there is no node.
    """
    paths = cut_lineage(prefixes(turns, *order).select(F.col("key").alias("path"), "depth", "node", "parent", "bytes"))
    root = F.lit(as_key(START))
    counted = paths.groupBy("path").agg(F.max("depth").alias("turns"))
    lengths = cut_lineage(
        conversations.select(F.col("key").alias("path")).distinct().join(counted, "path", "left").select("path", F.coalesce("turns", F.lit(0)).alias("turns"))
    )
    tops = lengths.select("path", F.lit(0).cast("bigint").alias("depth"), root.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("bytes"), "turns")
    steps = paths.join(lengths, "path").select("path", "depth", "node", "parent", "bytes", "turns").union(tops)
    nodes = cut_lineage(
        steps.groupBy("node")
        .agg(
            F.min("path").alias("path"),
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.max("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("n_convs"),
            F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"),
        )
    )
    children = cut_lineage(nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")))
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint")
    weighted = nodes.join(children, "node", "left").withColumns({"n_leaves": leaf, "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    sums = subtree_sums(weighted, paths, ["n_leaves", "saved_tokens"], local)
    ends = list_digests(steps.where(F.col("depth") == F.col("turns")).select("node", F.col("path").alias("key")))
    above = nodes.select(F.col("node").alias("parent"), F.col("path").alias("parent_conv_id"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    found = (
        nodes.join(children, "node", "left").join(sums, "node").join(ends, "node", "left").join(above, "parent", "left")
        .select(
            F.col("path").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
    return found


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """The trie of the rebuilt conversations of a table conv_id, turn, role, text; other columns are ignored.

    Turns are ordered by ``turn``, null first, equal ones by a digest of role and text; repeated rows are turns of their own.
    Null roles and texts are empty, rows with a null conv_id are left out. An empty table has no node.
    """
    items = turn_items(conversations)
    return prefix_trie(rebuilt(items), items.select("key"), "part", "place", local=local)
