from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.eigen import leading_eigenpairs
from bazaarlens.llm.queries import op12_embedding_whitening
from bazaarlens.llm.whitening import SHIFT, whiten

TESTDATA = os.environ.get("BAZAARLENS_TESTDATA", "/root/testdata/sf0.001")


def by_hand(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + SHIFT
    n = len(x)
    sums = [sum(map(int, column)) for column in x.T]
    deviation = [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x]
    centred = x - np.array([s / n for s in sums])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, e[::-1], v[:, ::-1]


@pytest.mark.parametrize("dims, wanted, kind", [(5, 8, "far"), (64, 32, "close"), (300, 32, "close"), (200, 12, "far"), (200, 6, "equal")])
def test_eigenpairs_against_dense_solver(dims, wanted, kind):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    e = {"far": 0.8 ** np.arange(dims), "close": 100 - np.sqrt(np.arange(dims)), "equal": np.where(np.arange(dims) < 3, 5.0, 1 / (1 + np.arange(dims)))}[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    calls = []
    values, vectors = leading_eigenpairs(lambda x: calls.append(x.shape[1]) or a @ x, dims, wanted)
    wanted = min(wanted, dims)
    assert np.abs(values - e[:wanted]).max() <= 1e-12 * e[0]
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * e[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12


@pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")
def test_query_against_dense_solver(spark):
    rows = spark.read.parquet(f"{TESTDATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, deviation, centred, e, v = by_hand([r["embedding"] for r in rows])
    place = {r["vec_id"]: k for k, r in enumerate(rows)}
    found = op12_embedding_whitening(spark, TESTDATA).collect()
    assert len(found) == 32 * n and {r["n"] for r in found} == {n}
    got = np.zeros((n, 32))
    for r in found:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[place[r["vec_id"]]]
        assert abs(r["explained"] / (e[r["component"] - 1] / e.sum()) - 1) < 1e-10
        assert r["identity_error"] < 1e-9
    want = centred @ v[:, :32] / np.sqrt(e[:32])
    want *= np.sign((want * got).sum(axis=0))
    assert np.abs(got - want).max() < 1e-7


def test_odd_vectors(spark):
    """Nulls, other lengths, repeated rows, null ids, constant entries, and clashing columns."""
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 5.0], [0.5, -1.0, 5.0], [0.25, 3.0, 5.0], [0.25, 3.0, 5.0], [-4.0, 0.0, 5.0]]
    rows = [(k, v) for k, v in enumerate(good[:-1])] + [(None, good[-1])]
    rows += [(10, None), (11, [1.0, None, 2.0]), (12, [nan, 1.0, 2.0]), (13, [1.0, 2.0, inf]), (14, []), (15, [1.0]), (16, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    clash = df.withColumns({c: F.lit("mine") for c in ("id", "vector", "n", "component", "block")})
    found = whiten(clash).collect()
    n, deviation, centred, e, _ = by_hand(good)
    assert {r["component"] for r in found} == {1, 2} and len(found) == 2 * n
    assert sorted((r["vec_id"] is None, r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == [
        *((False, k, deviation[k]) for k in range(4)), (True, None, deviation[4]),
    ]
    assert abs(sum(r["whitened"] ** 2 for r in found) - 2 * n) < 1e-9
    assert whiten(df.limit(0)).count() == 0
    assert whiten(df.where("vec_id in (2, 3)")).count() == 0
    huge = spark.createDataFrame([(1, [1e15, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert {r["deviation"] for r in whiten(huge).collect()} == {None}
