"""Whitening against numpy's eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from conftest import SMALL
from salesdw.llm import whitening
from salesdw.llm.queries import llm_queries

SCHEMA = "vec_id long, embedding array<float>, row int, x int, component int"


def expected(vectors):
    """fit list, S, covariance by exact integers."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.array(sorted({tuple(row) for row in x}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums).astype(float)) / n
    return x, n, sums, centred.T @ centred / n


def check(rows, vectors_by_id, components=16):
    x, n, sums, v = expected(list(vectors_by_id.values()))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(vectors_by_id)
    signs = None
    for vec_id, own in zip(vectors_by_id, x):
        line = got[vec_id]
        assert sorted(line) == list(range(1, components + 1))
        deviation = sum(int(n * a - s) ** 2 for a, s in zip(own, sums))
        whitened = ((n * own - sums).astype(float) / n) @ vectors[:, :components] / np.sqrt(values[:components])
        ours = np.array([line[c + 1].whitened for c in range(components)])
        if signs is None:
            signs = np.sign(ours * whitened)
        assert np.allclose(ours, signs * whitened, atol=1e-6)
        for c in range(components):
            assert line[c + 1].n == n and line[c + 1].deviation == deviation
            assert abs(line[c + 1].explained / (values[c] / np.trace(v)) - 1) < 1e-10
            assert line[c + 1].identity_error < 1e-9


def test_query(spark):
    rows = llm_queries()["op13_chebyshev_whitening"](spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check(rows, {r.vec_id: r.embedding for r in given})


def test_odd_rows(spark, staging):
    rng = np.random.default_rng(2)
    vectors = {number: rng.normal(size=40).tolist() for number in range(300)}
    vectors[300] = vectors[0]
    rows = [(i, v, 1, 2, 3) for i, v in vectors.items()]
    odd = [None, [], [None] * 40, [math.nan] * 40, [math.inf] * 40, [1.0] * 39, [1.0] * 41, [1e30] * 40]
    rows += [(1000 + number, v, 1, 2, 3) for number, v in enumerate(odd)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = whitening.whiten(docs, "embedding", staging)
    assert {r.row.component for r in found.collect()} == {3}
    floats = {i: np.array(v, np.float32).tolist() for i, v in vectors.items()}
    check(found.select("row.vec_id", "*").drop("row").collect(), floats)


def test_small_tables(spark, staging):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA), "embedding", staging).collect() == []
    equal = spark.createDataFrame([(1, [1.0, 2.0], 1, 2, 3), (2, [1.0, 2.0], 1, 2, 3)], SCHEMA)
    assert whitening.whiten(equal, "embedding", staging).collect() == []
    two = spark.createDataFrame([(1, [1.0, 2.0], 1, 2, 3), (2, [1.0, 3.0], 1, 2, 3), (2, [1.0, 3.0], 1, 2, 3)], SCHEMA)
    rows = whitening.whiten(two, "embedding", staging).collect()
    assert sorted((r.row.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 12)) for r in rows) == [
        (1, 1, 2, 64**2, 1.0),
        (2, 1, 2, 64**2, 1.0),
        (2, 1, 2, 64**2, 1.0),
    ]


def test_filter_damps_the_lower_spectrum():
    values = np.array([10.0, 9.0, 3.0, 2.0, 0.5, 0.0])
    damped = whitening.chebyshev_filter(lambda b: values[:, None] * b, np.eye(6), np.diag(values), 9, 0.0, 3.0)
    size = np.abs(np.diag(damped))
    assert (size[2:] <= 1 + 1e-9).all() and size[1] > 1e5 and size[0] > size[1]


def test_lower_end_is_below_the_spectrum():
    rng = np.random.default_rng(4)
    for size in (1, 2, 5, 40):
        turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
        values = rng.uniform(2, 9, size)
        matrix = turn * values @ turn.T
        assert 0 <= whitening.lower_end(lambda b: matrix @ b, size) <= values.min() + 0.5


def test_deviation_beyond_a_long_fails():
    assert whitening.exact_squares(np.array([[3, -4]])).tolist() == [25]
    with pytest.raises(OverflowError):
        whitening.exact_squares(np.array([[4_000_000_000, 1]]))
