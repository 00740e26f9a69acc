"""Clustering of vectors around centroids by progressive search over Walsh-Hadamard coefficients.

Vectors of ``SIZE`` components become integers, ``floor(SCALE * x)``. The Walsh-Hadamard transform
of integers is exact, and the squared distance of two transforms is ``SIZE`` times that of the
vectors. Coefficients come in the order of their sign changes, coarse to fine. Each vector adds up
the squared differences to all centroids level by level. After a few coefficients the centroid
ahead is finished, which gives a bound; from then on a centroid whose sum is already larger is
strictly worse and is left out. What is left adds up all ``SIZE`` coefficients, so distances and
ties (smaller number first) are exact.

A round is one pass over the table. Each task keeps one sum per centroid and component, Spark adds
those up, and the driver gets ``K * SIZE`` of them, however large the table is. No vector moves.

Vectors that are null, of another length, or have a null, infinite or NaN component are left out.
Rows that repeat an id or a vector count each for themselves; a row without an id is kept, its hash
is that of an empty id. Fewer than ``K`` vectors give fewer centroids, an empty table no rows.
Components of 2**21 and more after scaling are worked on as Python's integers; sums are exact up to
38 digits, and a distance or sum beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import settle

SIZE = 64
SCALE = 1024
K = 8
ROUNDS = 10
SEED = "3:"

#: Ends of the levels, in coefficients. The bound is taken after ``BOUND_AT`` of them.
LEVELS = (1, 2, 4, 8, 16, 32, 64)
BOUND_AT = 8
#: Below this, squared differences of all coefficients add up within 64 bits.
SMALL = 1 << 21
LONG = 1 << 63


def sequency() -> np.ndarray:
    """The natural order's coefficients by their number of sign changes."""
    rows = np.array([[1]])
    while len(rows) < SIZE:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


ORDER = sequency()


def transform(vectors: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard coefficients of each row, coarse to fine; exact for integers."""
    x, step = vectors, 1
    while step < SIZE:
        pairs = x.reshape(len(x), SIZE // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), SIZE)
        step *= 2
    return x[:, ORDER]


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite numbers, as 64-bit integers where those are safe."""
    if not len(values) or np.abs(values).max() < SMALL / SCALE - 1:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(v) * SCALE if abs(v) > 2.0**60 else int(np.floor(v * SCALE)) for v in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def kept_vectors(rows: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Ids and integer vectors of a batch ``(id, vector)``."""
    ids, vectors = rows.column(0), rows.column(1)
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), SIZE), False)
    ids, vectors = ids.filter(right), vectors.filter(right)
    # Nulls come out as NaN.
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, SIZE)
    finite = np.isfinite(values).all(axis=1)
    return ids.filter(pa.array(finite)), whole(values[finite])


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: smaller) and the squared distance to it."""
    x, c = transform(vectors), transform(centroids)
    if x.dtype != c.dtype or (c.dtype != object and len(c) and np.abs(centroids).max() >= SMALL):
        x, c = x.astype(object), c.astype(object)
    sums = np.zeros((len(x), len(c)), dtype=x.dtype)
    alive = np.ones(sums.shape, dtype=bool)
    bound, start = None, 0
    for stop in LEVELS:
        for k in range(len(c)):
            rows = np.flatnonzero(alive[:, k])
            differ = x[rows, start:stop] - c[k, start:stop]
            sums[rows, k] += (differ * differ).sum(axis=1)
            if bound is not None:
                alive[rows, k] = sums[rows, k] <= bound[rows]
        if stop == BOUND_AT:
            ahead = sums.argmin(axis=1)
            rest = x[:, stop:] - c[ahead, stop:]
            bound = sums[np.arange(len(x)), ahead] + (rest * rest).sum(axis=1)
            alive = sums <= bound[:, None]
        start = stop
    # Whoever is left out has a sum above the bound, which the nearest does not exceed.
    number = np.where(alive, sums, bound[:, None] + 1).argmin(axis=1)
    return number, sums[np.arange(len(x)), number] // SIZE


def first_centroids(vectors: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` kept vectors whose ids' hashes come first."""
    values = F.col("vector").cast("array<double>")
    sound = (F.size(values) == SIZE) & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    place = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.where(sound).select(place.alias("place"), values.alias("v")).orderBy("place", "v").limit(k).collect()
    return [whole(np.array(r.v, dtype=float)[None, :])[0].tolist() for r in rows]


def as_matrix(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < SMALL for c in centroids for x in c)
    return np.array(centroids, dtype=np.int64 if small else object).reshape(-1, SIZE)


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the means; an empty one stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = as_matrix(centroids)
        sums = np.zeros((len(matrix), SIZE), dtype=object)
        counts = np.zeros(len(matrix), dtype=np.int64)
        for rows in batches:
            _, found = kept_vectors(rows)
            if not len(found):
                continue
            number, _ = nearest(found, matrix)
            for k in np.unique(number):
                own = found[number == k]
                counts[k] += len(own)
                sums[k] += own.sum(axis=0).astype(object)
        k, dim = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k.ravel(), pa.int32()),
                pa.array(dim.ravel(), pa.int32()),
                pa.array(np.repeat(counts, SIZE)),
                pa.array([Decimal(int(x)) for x in sums.ravel()], pa.decimal128(38, 0)),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    parts = vectors.mapInArrow(run, "cluster int, dim int, n long, total decimal(38,0)")
    found = parts.where("n > 0").groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").cast("string").alias("total")).collect()
    new = [list(c) for c in centroids]
    for r in found:
        new[r.cluster][r.dim] = int(r.total) // r.n
    return new


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``id, cluster, distance`` of every kept vector."""
    id_type = dict(vectors.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = as_matrix(centroids)
        for rows in batches:
            ids, found = kept_vectors(rows)
            if not len(found):
                continue
            number, distance = nearest(found, matrix)
            fits = [d if d < LONG else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(fits, pa.int64())], names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {id_type}, cluster int, distance long")


def clusters(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid`` of every kept vector; the
    centroid is the list of its components as decimal text, joined by commas."""
    spark = rows.sparkSession
    vectors = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    centroids = first_centroids(vectors, k)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    found = settle(assigned(vectors, centroids), "assigned") if centroids else assigned(vectors.limit(0), [[0] * SIZE])
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row per centroid.
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(exact.alias("total")).collect()}
    long = lambda x: int(x) if x is not None and abs(x) < LONG else None
    total = long(sum(sums.values())) if None not in sums.values() else None
    told = [(i, long(sums.get(i)), total, ",".join(map(str, c))) for i, c in enumerate(centroids)]
    table = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid string")
    return found.join(F.broadcast(table), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
