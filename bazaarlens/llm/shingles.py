"""Word shingles of a text as arrays of digests, for code that runs inside tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

#: Words per shingle.
SIZE = 5

#: Each byte of a word in lower case, any other as a space.
_LETTERS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in bytes(range(256)).lower())
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: bytes | None) -> list[bytes]:
    """Words of ASCII letters and digits and non-ASCII characters, A-Z in lower case."""
    return text.translate(_LETTERS).split() if text else []


def digests(found: list[bytes]) -> np.ndarray:
    """Digest of every word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def runs(own: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Digest of every run of ``size`` words, from those of the words; of all words if there are fewer; nothing if there are none."""
    n = len(own)
    if not n:
        return np.empty(0, np.uint64)
    size = min(size, n)
    out = own[: n - size + 1].copy()
    for k in range(1, size):
        out *= _STEP
        out += own[k : n - size + 1 + k]
    return mixed(out + np.uint64(size))


def shingles(found: list[bytes], size: int = SIZE) -> np.ndarray:
    """Digest of every run of ``size`` words; of all words if there are fewer; nothing if there are none."""
    return runs(digests(found), size)


def in_pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes``, a row at least, so memory doesn't follow the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def in_tasks(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow(function, schema)``, with this package on the path of the Python workers.

    Workers of a session that was started elsewhere find it there if they see the driver's folder;
    on other machines it has to be installed or sent with the job.
    """
    known, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [path for path in known.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(function, schema)
