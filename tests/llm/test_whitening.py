import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import whitening as W
from paddock.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(vectors):
    """By length: n, exact sums, variances, components, and x of each sound vector."""
    by_length = {}
    for v in vectors:
        if v is None or not len(v) or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(min(max(1024 * c, -(2.0 ** 53)), 2.0 ** 53)) + 100000 for c in v]
        by_length.setdefault(len(x), []).append(x)
    out = {}
    for d, xs in by_length.items():
        n, sums = len(xs), [sum(c) for c in zip(*xs, strict=True)]
        centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in xs])
        e, u = np.linalg.eigh(centred.T @ centred / n)
        out[d] = n, sums, e[::-1], u[:, ::-1].T, xs, centred
    return out


def check(spark, vectors, components=8):
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA).repartition(3)
    got = {}
    for r in W.whitened(spark, df, components).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    want, seen = brute(vectors), {}
    for i, v in enumerate(vectors):
        if v is None or len(v) not in want or any(c is None or not math.isfinite(c) for c in v):
            assert i not in got
            continue
        n, sums, e, u, xs, centred = want[len(v)]
        at = seen.get(len(v), 0)
        seen[len(v)] = at + 1
        assert set(got[i]) == set(range(1, min(components, len(v)) + 1))
        square = sum((n * a - s) ** 2 for a, s in zip(xs[at], sums, strict=True))
        for k, r in got[i].items():
            assert r["n"] == n and r["deviation"] == (square if square < 2 ** 63 else None)
            if e[0] > 0:
                assert r["explained"] == pytest.approx(e[k - 1] / e.sum(), rel=1e-4, abs=1e-12)
                assert r["identity_error"] < 1e-4
            else:
                assert r["explained"] is None and r["identity_error"] is None
    return got, want


def test_equals_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 12)) * np.linspace(1.5, 0.01, 12) + 3
    got, want = check(spark, v.tolist())
    n, _, e, u, _, centred = want[12]
    w = centred @ u[:8].T / np.sqrt(e[:8])
    mine = np.array([[got[i][k]["whitened"] for k in range(1, 9)] for i in range(400)])
    signs = np.sign((mine * w).sum(axis=0))
    assert np.allclose(mine * signs, w, atol=1e-9)
    assert np.allclose(np.cov(mine.T, bias=True), np.eye(8), atol=1e-12)


def test_columns_of_very_different_scale(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 6)) * 10.0 ** np.arange(6)
    got, _ = check(spark, v.tolist())
    mine = np.array([[got[i][k]["whitened"] for k in range(1, 7)] for i in range(300)])
    assert np.allclose(np.cov(mine.T, bias=True), np.eye(6), atol=1e-6)


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(100, 2))
    v = np.hstack([a, a[:, :1], np.full((100, 1), 0.5)])
    got, want = check(spark, v.tolist())
    assert all(got[i][1]["whitened"] is not None and got[i][2]["whitened"] is not None for i in range(100))
    assert all(got[i][k]["whitened"] is None for i in range(100) for k in (3, 4))


def test_nulls_lengths_repeats_and_large_entries(spark):
    rng = np.random.default_rng(7)
    some = rng.normal(size=(40, 5)).tolist()
    odd = [None, [], [1.0, None, 2.0, 3.0, 4.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], [-math.inf] * 5]
    other = rng.normal(size=(9, 3)).tolist()
    check(spark, [*some, *odd, *other, *some[:3], [1.0, 2.0]])   # a length of its own for one vector
    check(spark, [[1e300, 0.0], [-1e300, 1.0], [2.0, 1e17], [0.0, 0.0]])
    check(spark, [[0.25, 0.5]] * 7)                                # nothing varies


def test_no_rows_and_other_columns(spark):
    assert W.whitened(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [2.0, 1.0], 1), (5, [0.0, 1.5], 1)], SCHEMA)
    df = df.withColumns({c: F.lit("x") for c in ("v", "dim", "n", "component", "row")})
    got = W.whitened(spark, df)
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in got.collect()) == [
        (False, 4, 1), (False, 4, 2), (False, 5, 1), (False, 5, 2), (True, 0, 1), (True, 0, 2)]


def test_lengths_in_rounds_and_the_table(spark, sf, monkeypatch):
    df = table(spark, sf.replace("0.001", "0.01"), "embeddings")
    rows = df.orderBy("vec_id").collect()
    check(spark, [r["embedding"] for r in rows])
    monkeypatch.setattr(W, "FACTOR_BYTES", 100)
    check(spark, [[1.0, 2.0], [2.0, 0.5], [3.0, 1.0], [1.0, 2.0, 4.0], [1.0, 5.0, 1.0]])


def test_triangular_solve():
    rng = np.random.default_rng(1)
    r = np.triu(rng.normal(size=(9, 9))) + 4 * np.eye(9)
    x = rng.normal(size=(20, 9))
    assert np.allclose(W.solved(x, r) @ r, x)
