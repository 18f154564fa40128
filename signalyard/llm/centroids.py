"""Exact centroid clustering of integer vectors with an n-simplex projection.

A few pivots, each clear of the flat through those before it, form a simplex.  A
vector's squared distances to the pivots (integers) fix where it stands as the
apex over that simplex: coordinates in the simplex's flat and an altitude above
it.  The distance of two vectors is at least that of their apexes on the same
side of the flat and at most that on opposite sides.  Each vector's apex is
worked out once and kept beside it in a written table; a round works out the
apexes of the centroids, drops for each vector the centroids whose lower bound
lies above another's upper bound, and compares the rest by exact integer
distances.  So the pivots decide the speed, never the result.

Pivots are taken from a bounded sample of vectors (``SAMPLE``): its first vectors
and the centroids that the same rounds find on the sample alone, since bounds are
tight for centroids near the pivots' flat.  All counts, sums and assignments cover
all vectors.  Rounds are Spark jobs over the written table; a task emits its
centroids' partial sums, and the driver holds centroids only."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signalyard.session import materialise

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 1024, 8, 10
#: Vectors from which pivots are taken, and how many pivots.
SAMPLE, PIVOTS = 8192, 32
#: Above it squared distances do not fit a long.
MAX_COMPONENT = 1 << 27
_MARGIN = 1e-7  # of squared distances, far above what doubles lose

SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` from the rows of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j, row in enumerate(b):
        d = a - row
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


class Simplex:
    """Pivots chosen from ``candidates`` (rows of integers): first the first one,
    then each time the one of greatest altitude, as long as it is well clear of
    the flat (equal vectors give a simplex of one pivot)."""

    def __init__(self, candidates: np.ndarray, most: int = PIVOTS):
        chosen, rows = [0], []
        base = squared(candidates, candidates[:1])[:, 0].astype(float)
        places, left = np.zeros((len(candidates), 0)), base.copy()
        while len(chosen) < most and left.max() > 1e-6 * base.max():
            j = int(left.argmax())
            row = np.append(places[j], np.sqrt(left[j]))
            new = ((base + base[j] - squared(candidates, candidates[j:j + 1])[:, 0]) / 2 - places @ row[:-1]) / row[-1]
            places, left = np.column_stack([places, new]), np.maximum(0.0, left - new * new)
            chosen.append(j)
            rows.append(row)
        self.pivots = candidates[chosen]
        self._rows = rows

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """A row for each vector: its coordinates in the flat, then its altitude."""
        d = squared(vectors, self.pivots).astype(float)
        places = np.zeros((len(vectors), len(self._rows)))
        for i, row in enumerate(self._rows):
            places[:, i] = ((d[:, 0] + row @ row - d[:, i + 1]) / 2 - places[:, :i] @ row[:-1]) / row[-1]
        altitude = np.sqrt(np.maximum(0.0, d[:, 0] - np.einsum("ij,ij->i", places, places)))
        return np.column_stack([places, altitude])


def possible(apexes: np.ndarray, centroid_apexes: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be nearest to each vector by the bounds."""
    a, c = apexes[:, :-1], centroid_apexes[:, :-1]
    flat = np.maximum(0.0, (a * a).sum(1)[:, None] + (c * c).sum(1) - 2 * a @ c.T)
    high, low = apexes[:, -1:], centroid_apexes[:, -1]
    margin = _MARGIN * (1 + (apexes * apexes).sum(1)[:, None] + (centroid_apexes * centroid_apexes).sum(1))
    lower, upper = flat + (high - low) ** 2 - margin, flat + (high + low) ** 2 + margin
    return lower <= upper.min(1)[:, None]


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centroid_apexes: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each vector, the smaller one on a tie."""
    may = possible(apexes, centroid_apexes)
    out = may.argmax(1)
    open_ = np.flatnonzero(may.sum(1) > 1)
    if len(open_):
        row, number = np.nonzero(may[open_])
        d = vectors[open_[row]] - centroids[number]
        exact = np.full((len(open_), len(centroids)), np.iinfo(np.int64).max)
        exact[row, number] = np.einsum("ij,ij->i", d, d)
        out[open_] = exact.argmin(1)
    return out


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and components floor(scale * x) of the vectors that have exactly
    ``dimensions`` components, none of them null or not finite."""
    x = F.col("embedding")
    wide = F.transform(x, lambda v: v.cast("double"))
    good = F.forall(wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .filter(x.isNotNull() & (F.size(x) == dimensions)).filter(good)
            .select("vec_id", F.transform(wide, lambda v: F.floor(scale * v)).alias("components")))


def _smallest_hashes(vectors: DataFrame, most: int, least: int) -> np.ndarray:
    """Components of the vectors whose ids have the smallest hashes: ``most`` of
    them, or somewhat fewer but at least ``least``.  Hashes are uniform, so only
    about twice as many rows as are wanted pass the first filter, however many
    tasks there are."""
    by_hash = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    hashed = vectors.select(by_hash.alias("hash"), "components")
    n, digits = vectors.count(), 12
    if n > 2 * most:
        some = hashed.filter(F.substring("hash", 1, digits) < F.lit(f"{2 * most * 16 ** digits // n:0{digits}x}"))
        rows = some.orderBy("hash", "components").limit(most).collect()
        if len(rows) >= least:
            return np.array([r["components"] for r in rows], dtype=np.int64)
    return np.array([r["components"] for r in hashed.orderBy("hash", "components").limit(most).collect()], dtype=np.int64)


def _matrix(column: pa.ListArray, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(matrix.ravel(), kind))


def _mean_down(sums: np.ndarray, n: int) -> np.ndarray:
    return sums // n


def _sample_path(sample: np.ndarray, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """All centroids that ``rounds`` rounds go through on the sample alone."""
    path = [centroids]
    for _ in range(rounds):
        at = squared(sample, centroids).argmin(1)
        centroids = np.array([_mean_down(sample[at == k].sum(0), int((at == k).sum())) if (at == k).any() else centroids[k]
                              for k in range(len(centroids))])
        path.append(centroids)
    return np.concatenate(path[::-1])


def _with_apexes(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            own = _matrix(batch.column(1), np.int64)
            if own.size and np.abs(own).max() > MAX_COMPONENT:
                raise ValueError(f"a component is beyond {MAX_COMPONENT}: squared distances would not fit a long")
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(own, pa.int32()), _lists(simplex.apexes(own), pa.float64())],
                                             names=["vec_id", "components", "apex"])
    return materialise(vectors.mapInArrow(run, "vec_id long, components array<int>, apex array<double>"), "apexes")


def _moved(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after a round: each task sums its vectors by centroid."""
    apexes = simplex.apexes(centroids)

    def run(batches):
        count, sums = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            own = _matrix(batch.column(0), np.int64)
            at = nearest(own, _matrix(batch.column(1), np.float64), centroids, apexes)
            count += np.bincount(at, minlength=len(centroids))
            for k in np.unique(at):
                sums[k] += own[at == k].sum(0)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), _lists(sums[some], pa.int64())],
                                             names=["cluster", "n", "sums"])

    parts = table.select("components", "apex").mapInArrow(run, "cluster int, n long, sums array<long>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    # one row a centroid and component
    rows = (parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
            .groupBy("cluster", "place").agg(exact("n").alias("n"), exact("part").alias("total")).collect())
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return out


def _assigned(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    apexes = simplex.apexes(centroids)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            own = _matrix(batch.column(1), np.int64)
            at = nearest(own, _matrix(batch.column(2), np.float64), centroids, apexes)
            d = own - centroids[at]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), pa.array(np.einsum("ij,ij->i", d, d))],
                                             names=["vec_id", "cluster", "distance"])
    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def clusters(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
             scale: int = SCALE, sample: int = SAMPLE, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each
    vector of ``embeddings`` (vec_id, embedding) that integer_vectors keeps.

    Centroids start as the ``k`` vectors of smallest sha256 of ``3:<vec_id>`` (a
    null vec_id hashes as an empty one; ties go by the components); fewer vectors
    give fewer centroids.  Repeated rows are vectors of their own; equal centroids
    leave the later ones empty, and those stay where they are; without a kept
    vector there are no rows; other columns are not read.  A component beyond
    MAX_COMPONENT is an error, as squared distances would not fit a long."""
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, dimensions, scale)
    drawn = _smallest_hashes(vectors, max(k, sample), k)
    if not len(drawn):
        return spark.createDataFrame([], SCHEMA)
    centroids = drawn[:k]
    simplex = Simplex(np.concatenate([_sample_path(drawn, centroids, rounds), drawn[:4 * pivots]]), pivots)
    table = _with_apexes(vectors, simplex)
    for _ in range(rounds):
        moved = _moved(table, centroids, simplex)
        if np.array_equal(moved, centroids):
            break  # all further rounds give the same
        centroids = moved
    assigned = materialise(_assigned(table, centroids, simplex), "assigned")
    inertia = F.sum(F.col("distance").cast("decimal(38,0)"))
    of_cluster = assigned.groupBy("cluster").agg(inertia.alias("d"))  # at most k rows
    of_all = of_cluster.agg(F.sum("d").cast("long").alias("inertia"))
    named = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())],
                                  "cluster int, centroid_sha256 string")
    about = of_cluster.select("cluster", F.col("d").cast("long").alias("cluster_inertia")).join(named, "cluster").withColumn("inertia", of_all.scalar())
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
