"""Running counts and sequence digests over rows in order, carried from one range of rows to the next."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import cut_lineage

#: Digests of sequences are polynomials at ``BASE`` modulo a prime of 127 bits, so that those of parts can be put together.
PRIME = (1 << 127) - 1
BASE = 0x5851F42D4C957F2D14057B7EF767814F
#: The digest of the sequence without members.
START = 1


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in ranges of ``order``, each sorted; written, so that a rerun meets the same ranges.

    A key of many rows takes several ranges.
    """
    return cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))


def as_key(digest: int) -> bytes:
    return digest.to_bytes(16, "big")


def _member(item: bytes) -> int:
    return int.from_bytes(item, "big") % PRIME


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a range: its first and last key, and count and digest of the last key's rows."""
    first = last = None
    n = digest = 0
    for batch in in_pieces(batches):
        keys = batch.column("key").to_numpy()
        first = int(keys[0]) if first is None else first
        own = np.flatnonzero(keys != keys[-1])
        low = int(own[-1]) + 1 if len(own) else 0
        if low or last != int(keys[-1]):
            last, n, digest = int(keys[-1]), 0, 0
        for item in batch.column("item").slice(low).to_pylist():
            digest = (digest * BASE + _member(item)) % PRIME
        n += batch.num_rows - low
    if first is not None:
        found = [TaskContext.get().partitionId()], [first], [last], [n], [as_key(digest)]
        types = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types)], names=["range", "first", "last", "n", "digest"])


def _carried(ends: list) -> dict[int, tuple[int, int, int]]:
    """Range -> (key, rows, digest) that the ranges before it hold of its first key."""
    out, key, n, digest = {}, None, 0, START
    for end in sorted(ends, key=lambda r: r["range"]):
        if key == end["first"]:
            out[end["range"]] = key, n, digest
        if not (key == end["first"] == end["last"]):
            key, n, digest = end["last"], 0, START
        digest = (digest * pow(BASE, end["n"], PRIME) + int.from_bytes(end["digest"], "big")) % PRIME
        n += end["n"]
    return out


def _continued(carried: dict[int, tuple[int, int, int]], others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, digest = carried.get(TaskContext.get().partitionId(), (None, 0, START))
        for batch in in_pieces(batches):
            depth, node, parent = [], [], []
            for own, item in zip(batch.column("key").to_pylist(), batch.column("item").to_pylist()):
                if own != key:
                    key, n, digest = own, 0, START
                parent.append(as_key(digest))
                n, digest = n + 1, (digest * BASE + _member(item)) % PRIME
                depth.append(n)
                node.append(as_key(digest))
            added = [pa.array(depth, pa.int64()), pa.array(node, pa.binary()), pa.array(parent, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *added, *(batch.column(c) for c in others)], names=["key", "depth", "node", "parent", *others]
            )

    return run


def prefixes(df: DataFrame, *order: str) -> DataFrame:
    """Every row with ``depth``, its place from 1 among the rows of its ``key``, and ``node`` and ``parent``.

    ``df`` has ``key`` (bigint), ``item`` (a digest of 16 bytes) and further columns. ``node`` is the digest of the items of
    the key up to this row in the given order, ``parent`` of those before it. Rows are sorted in
    ranges; a key that spans several is carried on from count and digest of each range's last key,
    of which the driver receives one row for each range.
    """
    ranges = in_ranges(df, "key", *order)
    ends = in_tasks(ranges.select("key", "item"), _ends, "range bigint, first bigint, last bigint, n bigint, digest binary").collect()
    others = [c for c in ranges.columns if c not in ("key", "item")]
    kept = ", ".join(f"{c} {ranges.schema[c].dataType.simpleString()}" for c in others)
    schema = f"key bigint, depth bigint, node binary, parent binary{', ' * bool(kept)}{kept}"
    return in_tasks(ranges, _continued(_carried(ends), others), schema)
