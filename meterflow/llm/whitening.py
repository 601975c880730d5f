"""Embedding whitening from a covariance weighted by multiplicity.

Entries become whole numbers x = floor(1024 * c) + 100000. Identical x vectors
are grouped and counted, map-side first, so that a vector which is repeated
millions of times is one row from there on. Fit weights are the counts (or one
for each distinct vector). The covariance is a weighted product of centred
vectors, one dims x dims block a task, summed by cell; centring is done on
n * x - S in integers, so nothing is lost to the offset. Each distinct vector
is whitened once, and the result is joined back to the rows by the SHA-256 of x.
Vectors that hold over a thousandth of the rows (under a thousand of them) are
joined by broadcast, so no task meets a hot key.

Defined cases: a row whose vector is null or holds a null or non-finite entry
is left out, and so is one whose number of entries isn't the commonest among
the others (ties: the larger number), as it has no place in the covariance. A
null vec_id is kept; repeated rows come back repeated. Directions without
variance (an eigenvalue not above 1e-12 of the trace) have null ``whitened``
and stay out of ``identity_error``; without any variance ``explained`` is null
too. A ``deviation`` beyond a long is null. An entry of 2^30 or more in size
raises. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.centroids import _matrix, finite_entries, scaled
from meterflow.llm.common import written

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8

#: Bound of an entry's size, and so of x: sums of 2^22 billion rows still fit a long.
LARGEST = 1 << 40

#: Vectors above this share of the rows are joined by broadcast (at most 1 / HOT of them).
HOT = 1 / 1000

#: Eigenvalues up to this share of the trace count as no variance.
FLAT = 1e-12


def usable(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x as whole numbers) of the rows that take part, and their number of entries."""
    v = F.col(column)
    good = vectors.where(v.isNotNull() & finite_entries(v))
    common = good.groupBy(F.size(v).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = common[0].dims if common else 0
    x = F.transform(scaled(v, SCALE, LARGEST), lambda e: e + OFFSET)
    return good.where(F.size(v) == dims).select("vec_id", x.alias("x")), dims


def _key():
    """The name of an x vector: the SHA-256 of its numbers."""
    return F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256)).alias("key")


def distinct(points: DataFrame) -> DataFrame:
    """(key, x, w): every different x vector and its number of rows."""
    return points.groupBy(_key(), "x").agg(F.count(F.lit(1)).alias("w"))


def _weight(weights: str):
    if weights not in ("counts", "one"):
        raise ValueError("weights are 'counts' or 'one'")
    return F.col("w") if weights == "counts" else F.lit(1).cast("long")


def sums(groups: DataFrame, dims: int, weights: str = "counts") -> tuple[int, np.ndarray]:
    """(n, S): weight and weighted sums a dimension, exact; one row reaches the driver."""
    w = _weight(weights)
    r = groups.agg(F.sum(w).alias("n"), F.array(*[F.sum(w * F.col("x")[i]) for i in range(dims)]).alias("s")).first()
    return r.n or 0, np.array(r.s if r.n else [0] * dims, np.int64)


def covariance(groups: DataFrame, n: int, s: np.ndarray, weights: str = "counts") -> np.ndarray:
    """The weighted covariance with divisor n; dims * (dims + 1) / 2 sums reach the driver."""
    dims = len(s)
    upper = np.triu_indices(dims)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            centred = (n * _matrix(b.column(0), dims, np.int64) - s) / n
            total += centred.T @ (centred * b.column(1).to_numpy()[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["cell", "value"])

    cells = groups.select("x", _weight(weights).alias("w")).mapInArrow(blocks, "cell long, value double")
    got = dict(cells.groupBy("cell").agg(F.sum("value").alias("value")).collect())
    v = np.zeros((dims, dims))
    v[upper] = np.array([got[i] for i in range(len(upper[0]))]) / n
    return v + np.triu(v, 1).T


def axes(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, share of the trace or nan), by falling eigenvalue; the largest entry is positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    trace = np.trace(v)
    return e, u, e / trace if trace > 0 else np.full(len(e), np.nan)


def _deviations(a: np.ndarray) -> pa.Array:
    """Sums of squares of whole numbers, exact; null beyond a long."""
    if not a.size or int(np.abs(a).max()) ** 2 * a.shape[1] < 1 << 63:
        return pa.array((a ** 2).sum(1))
    wide = [sum(v * v for v in row) for row in a.tolist()]
    return pa.array([d if d < 1 << 63 else None for d in wide], pa.int64())


def whitened_groups(groups: DataFrame, n: int, s: np.ndarray, e: np.ndarray, u: np.ndarray, flat: np.ndarray) -> DataFrame:
    """(key, w, deviation, z): every distinct vector whitened once."""
    dims, k = u.shape
    scale = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1.0, e)))

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = n * _matrix(b.column("x"), dims, np.int64) - s
            z = ((a / n) @ u * scale).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(z) + 1, k), pa.int32()), pa.array(z, from_pandas=True))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("w"), _deviations(a), lists], ["key", "w", "deviation", "z"])

    return groups.select("key", "x", "w").mapInArrow(whiten, "key binary, w long, deviation long, z array<double>")


def identity_error(groups: DataFrame, n: int, used: list[int], weights: str = "counts") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over the components ``used``."""
    if not used:
        return None
    w, z = _weight(weights).cast("double"), {i: F.col("z")[i] for i in used}
    mean = groups.agg(*[(F.sum(w * z[i]) / n).alias(f"m{i}") for i in used]).first()
    pairs = [(i, j) for i in used for j in used if i <= j]
    cov = groups.agg(*[(F.sum(w * (z[i] - mean[f"m{i}"]) * (z[j] - mean[f"m{j}"])) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """A row for every vector that takes part and every component, see the contract of the query."""
    points, dims = usable(vectors, column)
    groups = written(distinct(points), "distinct")
    n, s = sums(groups, dims, weights)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not n or not dims:
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    v = covariance(groups, n, s, weights)
    e, u, share = axes(v, components)
    flat = ~(e > FLAT * np.trace(v))
    done = written(whitened_groups(groups, n, s, e, u, flat), "whitened")
    error = identity_error(done, n, np.flatnonzero(~flat).tolist(), weights)

    keyed = written(points.select("vec_id", _key()), "keyed")
    rows = groups.agg(F.sum("w")).first()[0]
    hot = F.broadcast(done.where(F.col("w") > rows * HOT).select("key", "deviation", "z"))
    rest = done.where(F.col("w") <= rows * HOT).select("key", "deviation", "z")
    joined = keyed.join(hot, "key").unionByName(keyed.join(hot, "key", "left_anti").join(rest, "key"))
    shares = F.array(*[F.lit(None if np.isnan(x) else float(x)).cast("double") for x in share])
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("i") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
