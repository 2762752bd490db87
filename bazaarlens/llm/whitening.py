"""Whitening of embeddings by their leading principal components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.eigen import leading_eigenpairs
from bazaarlens.llm.shingles import in_pieces, in_tasks
from bazaarlens.session import written

COMPONENTS = 32
#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors that are stored together, rows of a partial sum that are added up in one task.
BLOCK, STRIPE = 4096, 64
#: Eigenvalues below this share of the greatest are those of no variation.
FLAT = 1e-12


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors: entry sums less SHIFT each, mean less SHIFT as whole and fractional part, components as columns."""

    n: int
    sums: tuple[int, ...]
    whole: np.ndarray
    part: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def usable(df: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector exists and holds finite numbers only, all of the most frequent length (of equally frequent ones the longest)."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    vector = F.col(vector_column)
    whole = df.where(vector.isNotNull() & F.forall(vector, entry) & (F.size(vector) > 0))
    usual = whole.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return whole.where(F.size(vector) == (usual["dims"] if usual else 0))


def _entries(batch: pa.RecordBatch) -> np.ndarray:
    """floor(SCALE * c), a row for each vector."""
    flat = batch.column("vector").flatten().to_numpy().astype(np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            x = _entries(batch.slice(at, BLOCK))
            columns = [pa.array([x.tobytes()], pa.binary()), pa.array([len(x)], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "n"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in in_pieces(batches, 1 << 24):
        for block, n in zip(batch.column("block"), batch.column("n").to_pylist()):
            yield np.frombuffer(block.as_buffer(), np.int64).reshape(n, -1)


def _summed(blocks: DataFrame, function, dtype: type) -> np.ndarray:
    """Sum over all blocks of a matrix that ``function`` makes of each.

    Every task sends its sum in stripes of rows; a stripe's parts are added in the order of the
    tasks. So the driver gets one matrix, however many tasks there are, and the same one in every run.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _unpacked(batches):
            own = function(x)
            total = own if total is None else total + own
        if total is not None:
            stripes = [total[at : at + STRIPE].tobytes() for at in range(0, len(total), STRIPE)]
            columns = [pa.array(range(len(stripes)), pa.int64()), pa.array([TaskContext.get().partitionId()] * len(stripes), pa.int64()), pa.array(stripes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["stripe", "task", "data"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe, total = None, None

        def output() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([stripe], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["stripe", "data"])

        for batch in in_pieces(batches):
            for own, data in zip(batch.column("stripe").to_pylist(), batch.column("data")):
                x = np.frombuffer(data.as_buffer(), dtype)
                if own != stripe:
                    if stripe is not None:
                        yield output()
                    stripe, total = own, x.copy()
                else:
                    total += x
        if stripe is not None:
            yield output()

    made = in_tasks(blocks, parts, "stripe bigint, task bigint, data binary").repartition("stripe").sortWithinPartitions("stripe", "task")
    rows = sorted(in_tasks(made, added, "stripe bigint, data binary").collect(), key=lambda r: r["stripe"])
    return np.concatenate([np.frombuffer(r["data"], dtype) for r in rows])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the covariance (divisor n) of ``vectors`` (column ``vector``, all of one length); None without rows.

    The covariance matrix is never formed: each step of the solver multiplies it with a block of
    vectors in one pass over the centred rows. What the driver holds are such blocks: length of a
    vector times some hundred numbers.
    """
    blocks = written(in_tasks(vectors.select("vector"), _blocks, "block binary, n bigint"), "vectors")
    n = blocks.agg(F.sum("n")).first()[0]
    if not n:
        return None
    sums = _summed(blocks, lambda x: x.sum(axis=0)[:, None], np.int64)
    dims = len(sums)
    exact = [int(s) for s in sums]
    whole = np.array([(2 * s + n) // (2 * n) for s in exact], np.int64)
    part = np.array([(s - n * int(w)) / n for s, w in zip(exact, whole)])
    centred = lambda x: (x - whole).astype(np.float64) - part

    def product(block: np.ndarray) -> np.ndarray:
        def run(x: np.ndarray) -> np.ndarray:
            own = centred(x)
            return own.T @ (own @ block)

        return _summed(blocks, run, np.float64).reshape(dims, -1) / n

    trace = float(_summed(blocks, lambda x: np.square(centred(x)).sum(axis=0)[:, None], np.float64).sum() / n)
    values, found = leading_eigenpairs(product, dims, components)
    varied = values > FLAT * max(trace, np.finfo(float).tiny)
    values, found = values[varied], found[:, varied]
    error = 0.0
    if len(values):

        def moments(x: np.ndarray) -> np.ndarray:
            y = (centred(x) @ found) / np.sqrt(values)
            return np.column_stack((y.T @ y, y.sum(axis=0)))

        total = _summed(blocks, moments, np.float64).reshape(len(values), -1) / n
        covariance = total[:, :-1] - np.outer(total[:, -1], total[:, -1])
        error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(n, tuple(exact), whole, part, values, found, trace, error)


def _deviations(x: np.ndarray, fitted: Whitening) -> list[int | None]:
    """Sum over entries of (n * x - S)^2, exact; None if it doesn't fit a bigint."""
    sums = np.array(fitted.sums, dtype=object)
    reach = max(abs(fitted.n * int(e) - s) for e, s in zip([*x.max(axis=0), *x.min(axis=0)], [*fitted.sums] * 2))
    if reach * reach * x.shape[1] < 1 << 63:
        d = x * fitted.n - sums.astype(np.int64)
        return [int(v) for v in (d * d).sum(axis=1)]
    found = [sum(int(d) ** 2 for d in fitted.n * row.astype(object) - sums) for row in x]
    return [v if v < 1 << 63 else None for v in found]


def _whitened(fitted: Whitening):
    k = len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches):
            x = _entries(batch)
            y = (((x - fitted.whole).astype(np.float64) - fitted.part) @ fitted.vectors) / np.sqrt(fitted.values)
            rows = np.repeat(np.arange(batch.num_rows), k)
            times = len(rows)
            columns = [
                batch.column("id").take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(times, fitted.n, np.int64)),
                pa.array(_deviations(x, fitted), pa.int64()).take(pa.array(rows)),
                pa.array(y.reshape(-1)),
                pa.array(np.tile(fitted.values / fitted.trace, batch.num_rows)),
                pa.array(np.full(times, fitted.identity_error)),
            ]
            names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def whiten(df: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row for each vector and component: id, ``component`` (from 1, by falling variance), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Vectors that are null or hold a null or non-finite entry have no rows, nor have empty ones and those of another
    length than most. Every other row counts, equal ones and those of a null id too. Components without variation are left
    out, so a table of equal vectors has no rows, and neither has an empty one. Other columns are ignored.
    ``deviation`` is null where it exceeds a bigint.
    """
    vectors = usable(df.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")), "vector")
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fitted = fit(vectors, components)
    if fitted is None or not len(fitted.values):
        out = df.sparkSession.createDataFrame([], schema)
    else:
        out = in_tasks(vectors, _whitened(fitted), schema)
    return out.withColumnRenamed("id", id_column)
