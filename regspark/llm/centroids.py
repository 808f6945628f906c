"""Centroid clustering in exact integers, with centroids ruled out by PCA-rotated bounds.

Vectors become integers once. Axes come from their second moments (summed by
Spark); the table of integers is stored with every vector's coordinates on the
leading axes and the norm of the rest. For a vector x and a centroid c

    |x - c|^2  >=  |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2

so the centroid with the smallest bound is measured first, in integers, and only
centroids whose bound does not exceed that distance are measured after it. The
bounds are floating point with a margin above their rounding; every distance
that decides is an exact integer, so axes change the work, never the result.

A round is one pass over the stored table: each task adds up its own vectors by
cluster, Spark adds up the tasks. The driver holds the centroids (k x dims), the
axes (dims x lead) and their moments (dims x dims), all free of the row count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stored

# Largest component as an integer: 64 squared differences still fit a long.
MAX_COMPONENT = 1 << 27
# Rounding margin of the bounds, relative to the squared norms (double precision has 2e-16).
MARGIN = 1e-9


def _matrix(column: pa.Array, dims: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten(), dtype).reshape(-1, dims)


def integer_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, v``: floor(scale * x) of the vectors with exactly ``dims`` finite components."""
    rows = pick(vectors, vec_id="long", embedding="array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))))
    fits = F.forall("v", lambda x: F.abs(x) <= F.lit(MAX_COMPONENT))
    too_large = F.raise_error(F.lit(f"a component is beyond {MAX_COMPONENT} after scaling: its distances do not fit a long"))
    return rows.where((F.size("embedding") == dims) & finite).select("vec_id", whole.alias("v")).select(
        "vec_id", F.when(fits, F.col("v").cast("array<int>")).otherwise(too_large.cast("array<int>")).alias("v"))


def leading_axes(ints: DataFrame, dims: int, lead: int) -> np.ndarray:
    """Orthonormal leading axes (dims x lead) of the vectors' second moments around their mean."""
    def moments(batches):
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = np.hstack([_matrix(batch.column(0), dims, np.float64), np.ones((batch.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "s"])

    total = np.zeros((dims + 1) ** 2)
    for row in ints.select("v").mapInArrow(moments, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        total[row.i] = row.s
    total = total.reshape(dims + 1, dims + 1)
    n = max(total[-1, -1], 1.0)
    _, axes = np.linalg.eigh(total[:-1, :-1] / n - np.outer(total[-1, :-1], total[-1, :-1]) / n / n)
    return np.ascontiguousarray(axes[:, ::-1][:, :lead])


def rotated(x: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest of every row."""
    x = x.astype(np.float64)
    y = x @ axes
    return y, np.sqrt(np.maximum(0.0, (x * x).sum(axis=1) - (y * y).sum(axis=1)))


def nearest(x: np.ndarray, y: np.ndarray, rest: np.ndarray, centroids: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), its squared distance, and how many distances were measured."""
    cy, crest = rotated(centroids, axes)
    bound = np.empty((len(x), len(centroids)))
    size = (y * y).sum(axis=1) + rest * rest + 1.0
    for k in range(len(centroids)):
        bound[:, k] = ((y - cy[k]) ** 2).sum(axis=1) + (rest - crest[k]) ** 2 - MARGIN * (size + float((centroids[k].astype(np.float64) ** 2).sum()))
    cluster = bound.argmin(axis=1)
    best = ((x - centroids[cluster]) ** 2).sum(axis=1)
    first, measured = cluster.copy(), len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((bound[:, k] <= best) & (first != k))
        if len(rows):
            d = ((x[rows] - centroids[k]) ** 2).sum(axis=1)
            measured += len(rows)
            closer = (d < best[rows]) | ((d == best[rows]) & (k < cluster[rows]))
            cluster[rows[closer]], best[rows[closer]] = k, d[closer]
    return cluster, best, measured


def _read(batch, dims: int, lead: int):
    return _matrix(batch.column("v"), dims, np.int64), _matrix(batch.column("lead"), lead, np.float64), np.asarray(batch.column("rest"))


def _sums(table: DataFrame, centroids: np.ndarray, axes: np.ndarray) -> DataFrame:
    """``cluster, dim, s``: componentwise sums of every cluster; dim = dims holds its count."""
    k, dims = centroids.shape

    def run(batches):
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x, y, rest = _read(batch, dims, axes.shape[1])
            cluster, _, _ = nearest(x, y, rest, centroids, axes)
            for c in range(k):
                own = x[cluster == c]
                total[c, :dims] += own.sum(axis=0)
                total[c, dims] += len(own)
        c, d = np.divmod(np.arange(total.size), dims + 1)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(total.ravel())], ["cluster", "dim", "s"])

    return table.mapInArrow(run, "cluster int, dim int, s long").groupBy("cluster", "dim").agg(F.sum("s").alias("s"))


def _assigned(table: DataFrame, centroids: np.ndarray, axes: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]

    def run(batches):
        for batch in batches:
            x, y, rest = _read(batch, dims, axes.shape[1])
            cluster, best, _ = nearest(x, y, rest, centroids, axes)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, lead: int = 8,
                    seed: str = "1") -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors start as floor(scale * x). Centroids start as the k kept vectors of
    smallest sha256 of ``seed:vec_id``; each round assigns every vector to its
    nearest centroid (squared distance, ties: smaller number) and moves every
    non-empty centroid to the floor of its vectors' mean; then vectors are
    assigned once more.

    Defined cases: vectors that are null, of another length or with a null or
    non-finite component are left out; a null vec_id is clustered but starts no
    centroid; repeated rows count once each, and equal hashes are ordered by
    their components; fewer than k vectors with an id start as many centroids;
    without any there are no rows. A component beyond 2^27 after scaling raises,
    since its distances do not fit a long. Other columns are ignored.
    """
    ints = integer_vectors(vectors, dims, scale)
    lead = min(lead, dims)
    axes = leading_axes(ints, dims, lead)

    def rotate(batches):
        for batch in batches:
            y, rest = rotated(_matrix(batch.column("v"), dims, np.int64), axes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * lead), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(rest)], ["vec_id", "v", "lead", "rest"])

    table = stored(ints.mapInArrow(rotate, "vec_id long, v array<int>, lead array<double>, rest double"), "rotated-vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = table.where("vec_id IS NOT NULL").select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    if not start:
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], empty)
    centroids = np.array([r.v for r in start], np.int64)
    for _ in range(rounds):
        total = np.zeros((len(centroids), dims + 1), np.int64)
        for r in _sums(table, centroids, axes).collect():
            total[r.cluster, r.dim] = r.s
        full = total[:, dims] > 0
        centroids[full] = total[full, :dims] // total[full, dims:]
    out = stored(_assigned(table, centroids, axes), "assigned-vectors")
    inertia = {r.cluster: r.s for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    place = F.col("cluster") + 1
    return out.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(int(inertia.get(c, 0))).cast("long") for c in range(len(names))]), place).alias("cluster_inertia"),
        F.lit(int(sum(inertia.values()))).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, names)), place).alias("centroid_sha256"))
