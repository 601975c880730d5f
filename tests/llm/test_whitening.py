"""Whitening against numpy over all rows."""

import math

import numpy as np
import pytest

from meterflow.llm import whitening as W
from tests.conftest import SF_SMALL


def check(df, rows):
    """Every row of the result of ``rows`` (vec_id, x) against a direct computation."""
    got, k = df.collect(), min(8, len(rows[0][1]))
    x, n = np.array([r[1] for r in rows], np.int64), len(rows)
    s = x.sum(0)
    a = (n * x - s) / n
    v = a.T @ a / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), c) for i, _ in rows for c in range(1, k + 1))
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    dev = {str(i): sum((n * int(p) - int(q)) ** 2 for p, q in zip(row, s)) for i, row in rows}
    assert all(r.deviation == dev[str(r.vec_id)] for r in got)
    want = a @ u / np.sqrt(e)
    at = {str(i): j for j, (i, _) in enumerate(rows)}
    z = np.zeros((n, k))
    for r in got:
        z[at[str(r.vec_id)], r.component - 1] = r.whitened
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) <= 1e-9 * r.explained
    signs = np.sign((z * want).sum(0))
    assert np.abs(z - want * signs).max() < 1e-6


def xs(vector):
    return [math.floor(1024 * c) + 100_000 for c in vector]


def test_query(spark):
    from meterflow.llm.queries import QUERIES
    rows = [(r.vec_id, xs(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, SF_SMALL), rows)


def test_hot_vector_odd_rows_and_clashing_columns(spark, monkeypatch):
    """A vector in a third of the rows takes the broadcast path, the others the shuffle."""
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=12).tolist()) for i in range(60)] + [(100 + i, [0.5] * 12) for i in range(30)] + [(None, [0.25] * 12)]
    bad = [(200, None), (201, []), (202, [1.0] * 11), (203, [None] * 12), (204, [math.nan] + [0.0] * 11), (205, [-math.inf] + [0.0] * 11)]
    monkeypatch.setattr(W, "HOT", 0.1)
    df = spark.createDataFrame([(i, v, 5, "k", 1.0) for i, v in good + bad], "vec_id long, embedding array<double>, w int, key string, z double")
    check(W.whitened(df.repartition(4)), [(i, xs(v)) for i, v in good])


def test_weights_of_one_count_distinct_vectors(spark):
    rng = np.random.default_rng(2)
    base = [rng.normal(size=5).tolist() for _ in range(20)]
    rows = [(i, base[i % 20] if i < 40 else base[0]) for i in range(70)]
    got = W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), weights="one").collect()
    assert {r.n for r in got} == {20} and len(got) == 70 * 5 and got[0].identity_error < 1e-9
    v = np.cov(np.array([xs(b) for b in base]).T, bias=True)
    assert abs(next(r.explained for r in got if r.component == 1) - np.linalg.eigvalsh(v)[-1] / np.trace(v)) < 1e-9
    with pytest.raises(ValueError):
        W.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), weights="x")


def test_empty_one_row_and_flat_directions(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])]):
        assert W.whitened(spark.createDataFrame(rows, kind)).collect() == []
    one = W.whitened(spark.createDataFrame([(1, [0.5, 0.25])], kind)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    line = W.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(10)], kind)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line) and line[0].identity_error < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    kind = "vec_id long, embedding array<double>"
    got = W.whitened(spark.createDataFrame([(0, [0.0, 0.0]), (1, [1e8, 0.0]), (2, [1.0, 5.0])], kind)).collect()
    assert [r.deviation for r in got if r.vec_id == 1] == [None, None]
    assert all(r.identity_error < 1e-4 for r in got)


def test_axes_are_orthonormal_and_signed():
    a = np.random.default_rng(4).normal(size=(50, 9))
    e, u, share = W.axes(a.T @ a)
    assert np.allclose(u.T @ u, np.eye(8)) and (np.diff(e) <= 0).all() and (u[np.abs(u).argmax(0), range(8)] > 0).all() and share.sum() < 1
