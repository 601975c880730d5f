"""Centroid clustering with PCA-rotated filtering.

Vectors are turned into integers, and k-means runs on those exactly. To spare
most of the distances, a rotation to the principal axes of all vectors is
stored with each vector: its leading rotated coordinates and the norm of the
rest. A rotation keeps distances, and two rests are at least as far apart as
their norms differ, so

    |leading - leading'|^2 + (rest norm - rest norm')^2

is never above the squared distance. A vector's distance to the centroid with
the least bound is computed in integers; only centroids whose bound isn't above
it are verified too, in integers. The bounds only save work: they carry a slack
far above their rounding errors, so results don't depend on the rotation.

Each round is one pass over the stored vectors; its tasks send one row of sums
a centroid, so a cluster that holds most vectors costs no more than another.

Defined cases: a vector that is null, has another number of components, or a
null or non-finite one is left out; a null vec_id is kept and hashed as the
empty text; repeated rows are vectors of their own (ties of the first hash are
ordered by components); with fewer vectors than centroids every vector starts
one; an empty table gives an empty result. A component of 2^26 or more in size
after scaling raises, as squared distances might not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import settled, written

DIMS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3

#: Rotated coordinates that are stored.
LEADING = 12

#: Bound of an integer component: 64 * (2 * 2^26)^2 = 2^60.
LARGEST = 1 << 26

#: Share of the squared norms by which a bound may be too high at most; rounding stays below 1e-12 of them.
SLACK = 1e-9


def finite_entries(vector: Column) -> Column:
    """Whether a vector has no null, NaN or infinite entry (null for a null vector)."""
    return F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def scaled(vector: Column, scale: int, largest: int) -> Column:
    """floor(scale * c) of every entry as long; raises beyond ``largest``."""
    def whole(c: Column) -> Column:
        v = c.cast("double") * float(scale)
        return F.when(F.abs(v) < float(largest), F.floor(v)).otherwise(
            F.raise_error(F.lit(f"a component of {largest / scale:g} or more in size")).cast("long"))

    return F.transform(vector, whole)


def kept(vectors: DataFrame, column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``x`` (whole numbers) of the rows that take part."""
    v = F.col(column)
    return vectors.where((F.size(v) == dims) & finite_entries(v)).select("vec_id", scaled(v, scale, LARGEST).alias("x"))


def first_centroids(points: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The k vectors with the least hash, in that order (k rows reach the driver)."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(h.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def rotation(points: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes as columns, by falling variance) over all vectors; dims * (dims + 3) / 2 + 1 sums reach the driver."""
    upper = np.triu_indices(dims)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dims + len(upper[0]))
        for b in batches:
            x = _matrix(b.column(0), dims, np.float64)
            total += np.concatenate([[len(x)], x.sum(0), (x.T @ x)[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])

    cells = points.select("x").mapInArrow(sums, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    got = dict(cells.collect())
    total = np.array([got.get(i, 0.0) for i in range(1 + dims + len(upper[0]))])
    n = max(total[0], 1.0)
    mean, square = total[1:1 + dims] / n, np.zeros((dims, dims))
    square[upper] = total[1 + dims:] / n
    square = square + np.triu(square, 1).T
    _, axes = np.linalg.eigh(square - np.outer(mean, mean))
    return mean, np.ascontiguousarray(axes[:, ::-1])


def turned(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the norm of the rest."""
    p = (x - mean) @ axes
    return p[:, :leading], np.sqrt((p[:, leading:] ** 2).sum(1))


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centers: np.ndarray, c_lead: np.ndarray,
            c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, distances computed); ties go to the smaller number."""
    own, theirs = (lead ** 2).sum(1) + rest ** 2, (c_lead ** 2).sum(1) + c_rest ** 2
    # The two squares written out: the sum of all squares less twice the products.
    bound = own[:, None] + theirs - 2 * (lead @ c_lead.T + np.outer(rest, c_rest))
    bound -= SLACK * (own[:, None] + theirs + 1)
    which = bound.argmin(1)
    best = ((x - centers[which]) ** 2).sum(1)
    todo = bound <= best[:, None]
    todo[np.arange(len(x)), which] = False
    verified = len(x) + int(todo.sum())
    for j in range(len(centers)):
        rows = np.flatnonzero(todo[:, j])
        d = ((x[rows] - centers[j]) ** 2).sum(1)
        better = (d < best[rows]) | ((d == best[rows]) & (j < which[rows]))
        best[rows[better]], which[rows[better]] = d[better], j
    return which, best, verified


class Clusters:
    """Stored vectors with their rotation; every method is one distributed pass."""

    def __init__(self, points: DataFrame, dims: int = DIMS, leading: int = LEADING):
        self.dims, self.leading = dims, min(leading, dims)
        self.mean, self.axes = mean, axes = rotation(points, dims)
        leading = self.leading

        def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lead, rest = turned(_matrix(b.column(1), dims, np.float64), mean, axes, leading)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, lead.size + 1, leading), pa.int32()), pa.array(lead.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists, pa.array(rest)], ["vec_id", "x", "lead", "rest"])

        kind = points.schema["vec_id"].dataType.simpleString()
        self.kind = kind
        self.stored = written(points.mapInArrow(store, f"vec_id {kind}, x array<long>, lead array<double>, rest double"), "rotated")

    def _assigner(self, centers: np.ndarray):
        dims, leading = self.dims, self.leading
        c_lead, c_rest = turned(centers.astype(np.float64), self.mean, self.axes, leading)

        def assign(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            x = _matrix(b.column("x"), dims, np.int64)
            lead = _matrix(b.column("lead"), leading, np.float64)
            which, best, _ = nearest(x, lead, b.column("rest").to_numpy(), centers, c_lead, c_rest)
            return x, which, best

        return assign

    def moved(self, centers: np.ndarray) -> np.ndarray:
        """One round: assigns all vectors and gives every centroid that has some the floor of their mean."""
        assign, k, dims = self._assigner(centers), len(centers), self.dims

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
            for b in batches:
                x, which, _ = assign(b)
                n += np.bincount(which, minlength=k)
                np.add.at(s, which, x)
            have = np.flatnonzero(n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(have) * dims + 1, dims), pa.int32()), pa.array(s[have].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(n[have]), lists], ["cluster", "n", "s"])

        parts = self.stored.select("x", "lead", "rest").mapInArrow(sums, "cluster long, n long, s array<long>")
        rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s")).collect()
        new = centers.copy()
        for r in rows:
            new[r.cluster] = [v // r.n for v in r.s]
        return new

    def assigned(self, centers: np.ndarray) -> DataFrame:
        """vec_id, cluster and squared distance of every vector."""
        assign = self._assigner(centers)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, which, best = assign(b)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array(which, pa.int32()), pa.array(best)], ["vec_id", "cluster", "distance"])

        return self.stored.mapInArrow(rows, f"vec_id {self.kind}, cluster int, distance long")


def clustered(vectors: DataFrame, column: str = "embedding", dims: int = DIMS, scale: int = SCALE, k: int = CENTROIDS,
              rounds: int = ROUNDS, leading: int = LEADING) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    points = kept(vectors, column, dims, scale)
    centers = first_centroids(points, k)
    out = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(centers):
        return points.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in out[2:5]],
                             F.lit("").alias(out[5])).limit(0)
    clusters = Clusters(points, dims, leading)
    for _ in range(rounds):
        centers = clusters.moved(centers)
    rows = settled(clusters.assigned(centers))
    totals = dict(rows.groupBy("cluster").agg(F.sum("distance")).collect())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]

    def looked_up(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return rows.select(
        "vec_id", "cluster", "distance", looked_up([totals.get(j, 0) for j in range(len(centers))], "long").alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("long").alias("inertia"), looked_up(names, "string").alias("centroid_sha256"))


def oracle() -> str:
    """DuckDB SQL for ``clustered`` with its defaults: every distance to every centroid."""
    def nearest_sql(c: str) -> str:
        d = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        return f"""SELECT rid, arg_min(j, {{'d': d, 'j': j}}) AS j, min(d) AS d
        FROM (SELECT p.rid, c.j, CAST({d} AS BIGINT) AS d FROM points p, {c} c) GROUP BY rid"""

    steps = [f"""
  points AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda v: isfinite(v))) = {DIMS}),
  c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS j, x FROM points QUALIFY j < {CENTROIDS})"""]
    for i in range(ROUNDS):
        steps.append(f"""
  a{i} AS MATERIALIZED ({nearest_sql(f'c{i}')}),
  m{i} AS MATERIALIZED (
    SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
    FROM (SELECT a.j, u.i, CAST(sum(u.v) AS BIGINT) AS s, count(*) AS n
          FROM a{i} a JOIN (SELECT rid, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM points) u USING (rid) GROUP BY 1, 2) GROUP BY j),
  c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (j))""")
    steps.append(f"""
  a AS MATERIALIZED ({nearest_sql(f'c{ROUNDS}')})""")
    return f"""
  WITH {",".join(steps)}
  SELECT p.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
         CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
  FROM points p JOIN a USING (rid) JOIN c{ROUNDS} c ON c.j = a.j"""
