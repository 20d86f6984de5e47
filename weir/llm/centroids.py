"""Centroid clustering over a distance matrix that is kept and updated, in whole numbers throughout.

A vector's components are the integers floor(64 * x). Its row of the matrix holds its dot product with each
centroid; with the squared norms |v|^2 - 2 v.c + |c|^2 is the exact squared distance. After a round only those
components of a centroid that moved change the dot products: each row adds v[j] * change[j] for these. So no round
computes a product anew, and the rows are written between rounds, which also cuts the lineage. Only the centroids
travel through the driver: ``k`` rows of ``dims`` whole numbers, whatever the number of vectors.

Defined cases: a vector that is NULL, has another number of components, or has a NULL or non-finite one, is left out;
a NULL id is spelled as nothing when the first centroids are chosen, and equal ids go by their components; repeated rows
are vectors like any other; with fewer vectors than centroids each vector is one; an empty table gives an empty
result; columns other than the named ones are ignored. A component beyond 2^27 stops the job: a distance to it need
not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import discard, keep_at

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Components up to here keep a squared distance of ``DIMS`` of them, and all dot products, within a long.
MOST = 1 << 27

_STATE = "vec_id long, v array<int>, norm long, dots array<long>"


def whole_vectors(table: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the whole-number components, of the vectors that are kept."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c))
    small = F.forall(x, lambda c: F.abs(c) * scale <= MOST)
    v = F.when(small, scaled.cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component lies beyond {MOST}")))
    kept = table.where(F.col("embedding").isNotNull() & (F.size("embedding") == dims) & finite)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of their ids, in that order."""
    spelled = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.select(F.sha2(spelled, 256).alias("hash"), "v").orderBy("hash", "v").limit(k).collect()  # k rows
    return np.array([row["v"] for row in chosen], np.int64).reshape(len(chosen), -1 if chosen else 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of an array column without NULLs, whose lengths are equal, as one matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _rows(ids: pa.Array, v: np.ndarray, norm: np.ndarray, dots: np.ndarray) -> pa.RecordBatch:
    def lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
        offsets = pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), kind))

    columns = [ids, lists(v.astype(np.int32), pa.int32()), pa.array(norm, pa.int64()), lists(dots, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "norm", "dots"])


def dot_products(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The state of the first round: each vector with its squared norm and its dot product with each centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"))
                yield _rows(batch.column("vec_id"), v, (v * v).sum(axis=1), v @ centroids.T)

    return vectors.select("vec_id", "v").mapInArrow(run, _STATE)


def changes(old: np.ndarray, new: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each centroid that moved: its number, the components that changed, and by how much."""
    found = []
    for number, moved in enumerate(new - old):
        at = np.flatnonzero(moved)
        if len(at):
            found.append((number, at, moved[at]))
    return found


def update_products(state: DataFrame, moved: list[tuple[int, np.ndarray, np.ndarray]]) -> DataFrame:
    """The state after the centroids moved; only their changed components are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v, dots = _matrix(batch.column("v")), _matrix(batch.column("dots"))
                for number, at, by in moved:
                    dots[:, number] += v[:, at] @ by
                yield _rows(batch.column("vec_id"), v, batch.column("norm").to_numpy(), dots)

    return state.mapInArrow(run, _STATE)


def nearest(dots: np.ndarray, norm: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number at ties, and the squared distance to it."""
    distance = norm[:, None] - 2 * dots + squares[None]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(cluster)), cluster]


def cluster_sums(state: DataFrame, squares: np.ndarray) -> DataFrame:
    """cluster, n and the sum of each component; a task adds up its rows first and sends a row for each cluster."""
    k = len(squares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"))
            total = np.zeros((k, v.shape[1]), np.int64) if total is None else total
            cluster, _ = nearest(_matrix(batch.column("dots")), batch.column("norm").to_numpy(), squares)
            count += np.bincount(cluster, minlength=k)
            for number in np.unique(cluster):
                total[number] += v[cluster == number].sum(axis=0)
        for number in np.flatnonzero(count):
            at = np.arange(total.shape[1], dtype=np.int32)
            columns = [np.full(len(at), number, np.int32), at, np.full(len(at), count[number]), total[number]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "at", "n", "total"])

    # A task's own sums fit a long; those of all tasks are added exactly, whatever their number.
    partial = state.select("norm", "v", "dots").mapInArrow(run, "cluster int, at int, n long, total long")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    return partial.groupBy("cluster", "at").agg(F.sum("n").alias("n"), exact.alias("total"))


def moved_centroids(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of its vectors' mean; one without vectors stays. Reads a row for each component."""
    new = centroids.copy()
    for row in sums.collect():
        new[row["cluster"], row["at"]] = int(row["total"]) // row["n"]
    return new


def assign(state: DataFrame, squares: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = nearest(_matrix(batch.column("dots")), batch.column("norm").to_numpy(), squares)
                columns = [batch.column("vec_id"), pa.array(found[0], pa.int32()), pa.array(found[1], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return state.select("vec_id", "norm", "dots").mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The state that belongs to the last centroids, and these. ``vectors`` is what ``whole_vectors`` returns.

    The state before the last is removed once the next is written, so the matrix is held twice at most.
    """
    centroids = first_centroids(vectors, k)
    state, path = keep_at(dot_products(vectors, centroids), "centroid-state")
    for _ in range(rounds):
        new = moved_centroids(cluster_sums(state, _squares(centroids)), centroids)
        moved, centroids = changes(centroids, new), new
        if not moved:  # later rounds would repeat this one
            break
        before = path
        state, path = keep_at(update_products(state, moved), "centroid-state")
        discard(state.sparkSession, before)
    return state, centroids


def _squares(centroids: np.ndarray) -> np.ndarray:
    return (centroids * centroids).sum(axis=1)


def _looked_up(cluster: Column, values: list, kind: str) -> Column:
    """The value of a cluster from a list with an entry for each."""
    return F.element_at(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), cluster + 1)


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """Each kept vector with its cluster, its distance, the inertias and the digest of its centroid."""
    state, centroids = fit(whole_vectors(table, dims), k, rounds)
    assigned = assign(state, _squares(centroids))
    if not len(centroids):
        none = F.lit(None)
        return assigned.withColumns(
            {"cluster_inertia": none.cast("long"), "inertia": none.cast("long"), "centroid_sha256": none.cast("string")}
        )
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # a row for each centroid
    inertia = {row["cluster"]: row["s"] for row in sums}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = F.col("cluster")
    return assigned.withColumns(
        {
            "cluster_inertia": _looked_up(of, [inertia.get(i, 0) for i in range(len(centroids))], "long"),
            "inertia": F.lit(sum(inertia.values())).cast("long"),
            "centroid_sha256": _looked_up(of, digests, "string"),
        }
    )

