"""Documents packed into token sequences: dominance reduction, then best fit."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Parts that the pieces of one length are numbered in.
SLICES = 1024
#: Words whose ids a worker remembers; cleared when full.
REMEMBERED = 1_200_000

_ENCODERS: dict = {}


class _Encoder(dict):
    """Ids of words between ASCII white space, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never joins what it separates, so a text's ids are
    those of its words in a row, and each distinct word needs to be encoded once. It
    lower-cases all but its special tokens, so A-Z may be lowered before.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)

    def ids(self, text: bytes | None) -> bytes:
        found = (text if b"<|" in text else text.lower()).split() if text else []
        new = [w for w in set(found) if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set(found))
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in new], add_special_tokens=False)
        self.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(new, encoded))
        return b"".join(map(self.__getitem__, found))


def encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in in_pieces(batches):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = encode.ids(text) + end
                for p, at in enumerate(range(0, len(own), 4 * capacity)):
                    part = own[at : at + 4 * capacity]
                    row.append(k), piece.append(p), start.append(at // 4), length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


class Plan:
    """Where the pieces of each length go, worked out on the number of pieces of each length.

    ``rows``: (length, first, n, sequence, each, offset): the pieces numbered ``first`` to
    ``first + n - 1`` of a length go ``each`` to a sequence from number ``sequence`` on,
    the first of them at ``offset``. Pieces of a length are alike, so work and result
    depend on the capacity and not on the number of documents.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {size: n for size, n in counts.items() if n}
        self.done = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.fixed = 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self._reduce()
        self._best_fit()

    def _place(self, size: int, sequences: int, each: int, first: int, offset: int) -> None:
        n = sequences * each
        self.rows.append((size, self.done[size], n, first, each, offset))
        self.done[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]

    def _fix(self, sizes: list[int], times: int) -> None:
        """``times`` sequences that hold just ``sizes``."""
        offset = 0
        for size in sizes:
            self._place(size, times, 1, self.sequences, offset)
            offset += size
        self.sequences += times
        self.fixed += times

    def _reduce(self) -> None:
        """Fixes sequences that are part of some best packing, until none can be shown to be.

        For a piece with room r beside it: nothing fits (it stays alone); a piece of exactly r
        exists (whatever else would share the sequence fits where that piece would
        go); or no two pieces fit together (the largest that fits is the best partner).
        """
        again = True
        while again:
            again = False
            for size in sorted(self.left, reverse=True):
                while size in self.left:
                    partner = self._partner(size)
                    if partner is None:
                        break
                    n = self.left[size]
                    if partner == 0:
                        self._fix([size], n)
                    elif partner == size:
                        self._fix_twins(size, n // 2)
                    else:
                        self._fix([size, partner], min(n, self.left[partner]))
                    again = True

    def _fix_twins(self, size: int, times: int) -> None:
        self._place(size, times, 2, self.sequences, 0)
        self.sequences += times
        self.fixed += times

    def _partner(self, size: int) -> int | None:
        """The length that some best packing puts beside ``size``: 0 for none, None if not known."""
        room = self.capacity - size
        self.left[size] -= 1
        sizes = sorted(s for s, n in self.left.items() if n and s <= room)
        least = sizes[0] if sizes else 0
        second = least if sizes and self.left[least] > 1 else (sizes[1] if len(sizes) > 1 else self.capacity)
        self.left[size] += 1
        if not sizes:
            return 0
        return sizes[-1] if sizes[-1] == room or least + second > room else None

    def _best_fit(self) -> None:
        """Longest first, each into the fullest sequence with room; runs of like sequences at once."""
        rooms: list[int] = []
        runs: dict[int, list[tuple[int, int]]] = {}

        def add(room: int, first: int, n: int) -> None:
            if room and n:
                if room not in runs:
                    insort(rooms, room)
                    runs[room] = []
                runs[room].append((first, n))

        for size in sorted(self.left, reverse=True):
            while size in self.left:
                at = bisect_left(rooms, size)
                if at == len(rooms):
                    room, first, n = self.capacity, self.sequences, self.left[size]
                    opened = -(-n // (room // size))
                    self.sequences += opened
                    n = opened
                else:
                    room = rooms[at]
                    first, n = runs[room].pop()
                    if not runs[room]:
                        del runs[room], rooms[at]
                each = room // size
                used = min(n, self.left[size] // each)
                if not used:
                    used, each = 1, self.left[size]
                self._place(size, used, each, first, self.capacity - room)
                add(room - each * size, first, used)
                add(room, first + used, n - used)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its token ids (no special tokens added) and ``end_id``. Longer ones than
    ``capacity`` are cut into pieces of that length, the last may be shorter. Pieces fill
    sequences of at most ``capacity`` without gaps from 0. ``with_ids`` adds the ids.

    The driver sees one number for each length, plans by dominance reduction and best fit
    (see ``Plan``), and sends the plan back, whose size depends on the capacity alone.
    Pieces of a length are numbered in slices, so a length that a third of all documents
    have is no single task's work.

    Null and empty texts are the end id alone. Rows with equal ids are documents each,
    alike rows take any of their places. An empty table has no pieces.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    pieces = cut_lineage(in_tasks(texts, _cut(tokenizer_path, capacity, end_id, with_ids), schema))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(counts, capacity)
    names = ["length", "first", "n", "sequence", "each", "offset"]
    rows = docs.sparkSession.createDataFrame(plan.rows, ", ".join(f"{c} bigint" for c in names))
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(SLICES)))
    per_slice = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_slice.select("length", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slice").orderBy("id", "piece", "ids_crc32", "start")
    numbered = (
        sliced.withColumn("place", F.row_number().over(inside) - 1)
        .join(bases, ["length", "slice"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    at = F.col("rank") - F.col("p.first")
    return (
        numbered.alias("d")
        .join(
            F.broadcast(rows.alias("p")),
            (F.col("d.length") == F.col("p.length")) & (at >= 0) & (at < F.col("p.n")),
        )
        .select(
            F.col("d.id").alias(id_column),
            "d.piece",
            "d.start",
            "d.length",
            "d.ids_crc32",
            (F.col("p.sequence") + F.expr("(d.rank - p.first) div p.each")).alias("sequence_id"),
            (F.col("p.offset") + at % F.col("p.each") * F.col("d.length")).alias("offset"),
            *(["d.ids"] if with_ids else []),
        )
    )
