"""Centroid clustering on an incremental matrix of exact integer dot products.

Components become integers, so every sum is exact whatever the partitions. Each vector
carries its dot products with all centroids; a round replaces only what a centroid's
changed components contribute to them, takes distances from |x|^2 - 2 x.c + |c|^2 and
finds the nearest centroid anew. The state is written after every round to the shared
folder (an executor that is lost costs its running tasks only) and the state before it
is deleted. To the driver come sums per cluster and component.

Defined cases: vectors that are null, of another length, or hold null or non-finite
components are left out; a vector with a component of 2**19 or more in size is kept, but
its cluster and distance are null and it moves no centroid (its squared distances do not
fit a long); equal vectors and repeated ids are vectors of their own; a null id comes
last among the seeds; fewer vectors than centroids make fewer centroids; of equally near
centroids the smaller number wins; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.session import scratch_folder

CENTROIDS = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2
LARGEST = 1 << 19  # components are below it: squared distances then fit a long

_STATE = "id long, x array<int>, norm long, dots array<long>, cluster int, distance long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1), kind))


def _state(ids: pa.Array, x: np.ndarray, norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    distances = norm[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)
    nearest = distances.argmin(axis=1)  # the first of equals
    columns = [
        ids,
        _lists(x, pa.int32()),
        pa.array(norm),
        _lists(dots, pa.int64()),
        pa.array(nearest.astype(np.int32)),
        pa.array(distances[np.arange(len(x)), nearest]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["id", "x", "norm", "dots", "cluster", "distance"])


def change_dots(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids moved by ``change``: nonzero components only."""
    for k in np.flatnonzero(change.any(axis=1)):
        moved = np.flatnonzero(change[k])
        dots[:, k] += x[:, moved] @ change[k, moved]
    return dots


def vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """id, x (integer components; null if one is too large) of every usable vector."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    large = F.exists(v, lambda c: F.abs(c) >= LARGEST)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.coalesce(F.size(v) == dim, F.lit(False)) & ~F.coalesce(bad, F.lit(False)))
    whole = F.transform(v, lambda c: F.floor(c * scale).cast("int"))
    return rows.select("id", F.when(~large, whole).alias("x"))


def seed_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``seed:id``; equal ids by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select(order.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def _first_state(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), centroids.shape[1])
            yield _state(batch.column("id"), x, (x * x).sum(axis=1), x @ centroids.T, centroids)

    return rows.mapInArrow(run, _STATE)


def _next_state(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), after.shape[1])
            dots = change_dots(_matrix(batch.column("dots"), len(after)), x, after - before)
            yield _state(batch.column("id"), x, batch.column("norm").to_numpy(), dots, after)

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of the mean of every cluster; empty clusters keep their centroid."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, cluster = _matrix(batch.column("x"), dim), batch.column("cluster").to_numpy()
            counts += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += x[cluster == c].sum(axis=0)
        used = np.flatnonzero(counts)
        columns = [pa.array(used.astype(np.int32)), pa.array(counts[used]), _lists(sums[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums"])

    partial = state.select("x", "cluster").mapInArrow(run, "cluster int, n long, sums array<long>")
    exact = "decimal(20,0)"
    rows = (
        partial.select("cluster", "n", F.posexplode("sums").alias("at", "value"))
        .groupBy("cluster", "at")
        .agg(F.sum(F.col("value").cast(exact)).alias("value"), F.sum(F.col("n").cast(exact)).alias("n"))
        .collect()
    )
    moved = centroids.copy()
    for r in rows:
        moved[r.cluster, r.at] = int(r.value) // int(r.n)
    return moved


def _delete(spark, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cluster_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(id, x, cluster, distance of every vector; the final centroids)."""
    spark = df.sparkSession
    rows = stored(vectors(df, id_col, vector_col, dim, scale))
    fit = rows.filter("x IS NOT NULL")
    nothing = rows.filter("x IS NULL").select(
        "id", "x", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")
    )
    centroids = seed_centroids(fit, k, seed)
    if not len(centroids):
        return nothing, centroids.reshape(0, dim)

    def written(state: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_folder(spark)
        state.write.parquet(path)
        return spark.read.schema(state.schema).parquet(path), path

    state, path = written(_first_state(fit, centroids))
    for _ in range(rounds):
        moved = _means(state, centroids)
        if (moved == centroids).all():
            break
        (state, after), before = written(_next_state(state, centroids, moved)), path
        _delete(spark, before)
        centroids, path = moved, after
    return state.select("id", "x", "cluster", "distance").unionByName(nothing), centroids


def describe_clusters(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add cluster_inertia, inertia and centroid_sha256 to the rows of ``cluster_vectors``."""
    spark = found.sparkSession
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in sums if r.cluster is not None}
    most = np.iinfo(np.int64).max
    total = sum(inertia.values())
    table = [
        (
            c,
            inertia.get(c, 0) if inertia.get(c, 0) <= most else None,
            total if total <= most else None,
            hashlib.sha256(",".join(map(str, values)).encode()).hexdigest(),
        )
        for c, values in enumerate(centroids.tolist())
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per centroid.
    return found.join(F.broadcast(spark.createDataFrame(table, schema)), "cluster", "left")
