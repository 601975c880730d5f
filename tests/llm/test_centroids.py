"""Centroid clustering against plain k-means on whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from meterflow.llm import centroids as C
from tests.conftest import SF_SMALL


def brute(rows, k=C.CENTROIDS, rounds=C.ROUNDS):
    """rows of (vec_id, list of whole numbers) -> sorted result rows."""
    first = sorted(rows, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(x) for _, x in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centers)) for _, x in rows]

    for _ in range(rounds):
        got = assign()
        for j in range(len(centers)):
            mine = [x for (_, x), (_, at) in zip(rows, got) if at == j]
            if mine:
                centers[j] = [math.floor(sum(col) / 1) // len(mine) for col in zip(*mine)]
    got = assign()
    total = sum(d for d, _ in got)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((str(i), j, d, sum(x for x, y in got if y == j), total, sha[j]) for (i, _), (d, j) in zip(rows, got))


def result(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_query(spark):
    from meterflow.llm.queries import QUERIES
    rows = [(r.vec_id, [math.floor(64 * c) for c in r.embedding]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert result(QUERIES["op11_centroids"](spark, SF_SMALL)) == brute(rows)


def test_odd_rows_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.integers(-4, 4, 64).tolist()) for i in range(40)]
    good += [(50, good[0][1]), (50, good[0][1]), (None, good[1][1]), (51, [0] * 64), (52, [9] * 64)]
    vectors = [(i, [v / 64 for v in x]) for i, x in good]
    bad = [(60, None), (61, []), (62, [0.0] * 63), (63, [None] + [0.0] * 63), (64, [math.nan] + [0.0] * 63), (65, [math.inf] + [0.0] * 63)]
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in vectors + bad], "vec_id long, embedding array<double>, cluster int, x string, distance double")
    assert result(C.clustered(df.repartition(5))) == brute(good)


def test_few_vectors_none_and_too_large(spark):
    kind = "vec_id long, embedding array<float>"
    few = [(7, [1.0] * 64), (8, [2.0] * 64)]
    assert result(C.clustered(spark.createDataFrame(few, kind))) == brute([(i, [int(64 * v) for v in x]) for i, x in few])
    for rows in ([], [(1, None)]):
        df = C.clustered(spark.createDataFrame(rows, kind))
        assert df.collect() == [] and df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="or more in size"):
        C.clustered(spark.createDataFrame([(1, [1e30] * 64)], kind)).collect()


@pytest.mark.parametrize("leading", [1, 12, 63, 64])
@pytest.mark.parametrize("spread", [1, 1 << 25])
def test_filter_never_loses_the_nearest_and_saves_work(leading, spread):
    """Bounds hold for any rotation, for equal distances too; on clustered data few distances are computed."""
    rng = np.random.default_rng(leading)
    base = rng.integers(-spread, spread + 1, (16, 64))
    x = np.clip(base[rng.integers(0, 16, 500)] + rng.integers(-1, 2, (500, 64)), -C.LARGEST + 1, C.LARGEST - 1)
    centers = np.vstack([base[:10], base[:3], x[:3]])
    mean, axes = x.mean(0), np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    which, best, verified = C.nearest(x, *C.turned(x.astype(float), mean, axes, leading), centers, *C.turned(centers.astype(float), mean, axes, leading))
    d = ((x[:, None].astype(object) - centers) ** 2).sum(2)
    assert (best == d.min(1)).all() and (which == [list(r).index(min(r)) for r in d]).all()
    if spread > 1 and leading > 1:
        assert verified < 500 * 16 / 3


def test_oracle_counts_a_vector_in_most_rows(spark):
    """A vector that holds most rows: sums are combined in tasks, one row a centroid."""
    rows = [(i, [1.0] * 64) for i in range(300)] + [(300 + i, [i / 64] * 64) for i in range(30)]
    got = result(C.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)))
    assert got == brute([(i, [math.floor(64 * v) for v in x]) for i, x in rows])
