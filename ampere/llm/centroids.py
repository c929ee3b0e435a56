"""Centroid clustering in exact integers, filtered by PCA-rotated coordinates.

Every component becomes the integer ``floor(scale * x)``. The vectors' moments are summed
over the cluster; their eigenvectors rotate the space, and each vector stores its leading
rotated coordinates and the norm of the rest. For a vector and a centroid, the squared
distance of the leading coordinates plus the squared difference of the residual norms never
exceeds their squared distance (by the triangle inequality in the space left out). So only
the centroids whose bound is within the exact distance of the most promising one are
verified, in integers: results are those of the full search, whatever the rotation.

A round is one pass that sums integers per centroid in each task; Spark adds the sums of the
tasks up, and centroids (``k`` rows of ``dims`` numbers, the only data on the driver)
become exact floors of the means. Clusters of any size are sums, never groups.

Defined results: vectors that are null, of another length, or with null or non-finite
components are left out; integers are clipped to +-2^27, so that distances fit in a long;
rows that repeat count as often as they occur; rows of equal id are ordered by their
components when centroids are seeded; null ids are seeded last; with fewer rows than ``k``
there are fewer centroids, an empty table gives an empty result; sums beyond a long are
null; an input column named like an added one is replaced; other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ampere.llm.common import Scratch, fresh, without

SCALE = 256
DIMS = 64
CLUSTERS = 40
ROUNDS = 5
#: Rotated coordinates that are stored; the residual norm is one more.
LEADING = 16
LIMIT = 1 << 27
#: Room for rounding in the bound, relative to the squared lengths that enter it.
SLACK = 1e-9
ADDED = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def integers(flat: np.ndarray, dims: int, scale: float = SCALE) -> np.ndarray:
    """Rows of ``floor(scale * x)``."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat.astype(np.float64) * scale)
    return np.clip(scaled, -LIMIT, LIMIT).astype(np.int64).reshape(-1, dims)


def rotate(x: np.ndarray, mean: np.ndarray, basis: np.ndarray, leading: int) -> np.ndarray:
    """Leading rotated coordinates and the norm of the others."""
    y = (x - mean) @ basis
    return np.hstack([y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(1))[:, None]])


def nearest(x: np.ndarray, p: np.ndarray, centroids: np.ndarray, q: np.ndarray):
    """Per row the nearest centroid (ties: the smaller number), its squared distance, and
    how many centroids were verified in all."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    own, theirs = (p * p).sum(1), (q * q).sum(1)
    bound = own[:, None] + theirs[None, :] - 2 * (p @ q.T)
    best = bound.argmin(1)
    least = ((x - centroids[best]) ** 2).sum(1)
    room = least * (1 + SLACK) + SLACK * (own + theirs.max()) + 1e-6
    open_ = bound <= room[:, None]
    open_[np.arange(len(x)), best] = False
    for c in np.flatnonzero(open_.any(0)):
        rows = np.flatnonzero(open_[:, c])
        d = ((x[rows] - centroids[c]) ** 2).sum(1)
        won = (d < least[rows]) | ((d == least[rows]) & (c < best[rows]))
        best[rows[won]], least[rows[won]] = c, d[won]
    return best, least, int(open_.sum()) + len(x)


def _ints(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def _points(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, width)


def _packed(rows: np.ndarray):
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _moments(x: DataFrame, dims: int):
    """Mean and covariance of the integer vectors; per task one sum, added up by Spark."""
    def work(batches):
        total = np.zeros((dims + 1, dims))
        n = 0
        for b in batches:
            v = _ints(b.column(0), dims).astype(np.float64)
            total[:dims] += v.T @ v
            total[dims] += v.sum(0)
            n += len(v)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims + 1), pa.int32()), pa.array([n] * (dims + 1), pa.int64()),
                 pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "n", "row"])

    rows = (x.mapInArrow(work, "i int, n long, row array<double>")
            .select("i", "n", F.posexplode("row").alias("j", "v"))
            .groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())
    total, n = np.zeros((dims + 1, dims)), 1
    for r in rows:
        total[r.i, r.j], n = r.v, r.n
    mean = total[dims] / n
    return mean, total[:dims] / n - np.outer(mean, mean)


def _sums(stored: DataFrame, centroids: np.ndarray, q: np.ndarray, dims: int, width: int) -> list:
    """Per centroid the number of its vectors and their component sums."""
    k = len(centroids)

    def work(batches):
        total = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            x, p = _ints(b.column(0), dims), _points(b.column(1), width)
            best, _, _ = nearest(x, p, centroids, q)
            for c in np.unique(best):
                mine = best == c
                total[c, :dims] += x[mine].sum(0)
                total[c, dims] += mine.sum()
        used = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
            names=["c", "row"])

    return (stored.mapInArrow(work, "c int, row array<long>")
            .select("c", F.posexplode("row").alias("j", "v"))
            .groupBy("c", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())


def cluster(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", k: int = CLUSTERS,
            dims: int = DIMS, rounds: int = ROUNDS, seed: int = 2, scale: float = SCALE,
            leading: int = LEADING) -> DataFrame:
    """Every usable row with its cluster, squared distance, inertias and centroid digest."""
    spark = vectors.sparkSession
    scratch, leading = Scratch(spark, "centroids"), min(leading, dims)
    names = [*vectors.columns, *ADDED]
    x_, p_ = fresh(names, "_x"), fresh(names, "_p")
    v = vectors[f"`{column}`"].cast("array<double>")
    usable = (F.size(v) == dims) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    raw = vectors.filter(F.coalesce(usable, F.lit(False))).select(*without(vectors, ADDED), v.alias(x_))
    at = raw.columns.index(x_)

    def to_integers(batches):
        for b in batches:
            x = integers(b.column(at).flatten().to_numpy(zero_copy_only=False), dims, scale)
            yield pa.RecordBatch.from_arrays(
                [_packed(x.astype("<i4")) if i == at else b.column(i) for i in range(b.num_columns)],
                names=b.schema.names)

    schema = T.StructType([T.StructField(x_, T.BinaryType()) if f.name == x_ else f for f in raw.schema.fields])
    whole = scratch.write(raw.mapInArrow(to_integers, schema))
    mean, covariance = _moments(whole.select(x_), dims)
    basis = np.ascontiguousarray(np.linalg.eigh(covariance)[1][:, ::-1])

    def to_points(batches):
        for b in batches:
            p = rotate(_ints(b.column(at), dims), mean, basis, leading)
            yield pa.RecordBatch.from_arrays([*b.columns, _packed(p)], names=[*b.schema.names, p_])

    stored = scratch.write(whole.mapInArrow(
        to_points, T.StructType([*whole.schema.fields, T.StructField(p_, T.BinaryType())])))

    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id}`").cast("string")), 256)
    seeds = whole.select(first.alias("h"), F.col(x_)).orderBy(F.asc_nulls_last("h"), x_).limit(k).collect()
    scratch.drop(whole)
    centroids = np.array([np.frombuffer(r[x_], "<i4") for r in seeds], np.int64).reshape(-1, dims)
    digits = stored.select(x_, p_)
    for _ in range(rounds):
        q = rotate(centroids, mean, basis, leading)
        sums: dict[int, dict[int, int]] = {}
        for r in _sums(digits, centroids, q, dims, leading + 1):
            sums.setdefault(r.c, {})[r.j] = int(r.v)
        centroids = centroids.copy()
        for c, row in sums.items():
            centroids[c] = [row[j] // row[dims] for j in range(dims)]
    q = rotate(centroids, mean, basis, leading)

    def assign(batches):
        for b in batches:
            best, least, _ = nearest(_ints(b.column(at), dims), _points(b.column(at + 1), leading + 1), centroids, q)
            rest = [i for i in range(b.num_columns) if i not in (at, at + 1)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in rest), pa.array(best, pa.int32()), pa.array(least, pa.int64())],
                names=[*(b.schema.names[i] for i in rest), "cluster", "distance"])

    kept = [f for f in stored.schema.fields if f.name not in (x_, p_)]
    assigned = scratch.write(stored.mapInArrow(assign, T.StructType(
        [*kept, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])))
    scratch.drop(stored)
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def long(n: int):
        return n if n < 1 << 63 else None

    per = spark.createDataFrame(
        [(c, long(s), long(sum(inertia.values())),
          hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, s in inertia.items()],
        "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.join(F.broadcast(per), F.col("cluster") == F.col("c"))  # at most k rows
    return out.select(*(F.col(f"`{f.name}`") for f in kept), *ADDED)
