"""Exact k-means on integer vectors, each assigned by an equal-average equal-variance search.

Centroids are sorted by the sum of their components. A vector's search starts at its own
sum and goes outward, so that the first centroid whose mean alone is too far ends it; one
whose deviation is too far as well is passed over without its distance, and what is left
is compared by exact squared distances in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.workspace import settle

SCALE = 1024
#: Part of the vectors' sizes by which bounds in doubles are lowered before they reject anything.
SLACK = 1e-9
#: Vectors that are searched together.
ROWS = 16_384


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The number of each vector's nearest centroid, the squared distance, and how many distances were computed.

    Both are integers. Of equal distances the smaller number wins: a centroid is rejected
    only if its bound lies above the best distance.
    """
    size = max(vectors.shape[1], 1)

    def moments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sqrt(size) times the mean, and the norm of the deviations from it."""
        real = rows.astype(np.float64)
        mean = real.sum(axis=1) / math.sqrt(size)
        return mean, np.sqrt(((real - real.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))

    mean, deviation = moments(vectors)
    own_mean, own_deviation = moments(centroids)
    order = np.argsort(own_mean, kind="stable")
    own_mean, own_deviation = own_mean[order], own_deviation[order]
    slack, own_slack = (SLACK * (np.abs(m) + d + 1) for m, d in ((mean, deviation), (own_mean, own_deviation)))

    def apart(kind: np.ndarray, own: np.ndarray, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """A lower bound of the squared difference, whatever was rounded before."""
        return np.maximum(np.abs(kind[rows] - own[place]) - slack[rows] - own_slack[place], 0) ** 2

    above = np.searchsorted(own_mean, mean)
    below = above - 1
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    number = np.full(len(vectors), len(centroids))
    computed = 0
    going = np.arange(len(vectors))
    last = len(centroids) - 1
    while len(going):
        up = np.where(above[going] <= last, own_mean[np.minimum(above[going], last)] - mean[going], np.inf)
        down = np.where(below[going] >= 0, mean[going] - own_mean[np.maximum(below[going], 0)], np.inf)
        upward = up <= down
        place = np.where(upward, above[going], below[going])
        inside = np.isfinite(np.minimum(up, down))
        going, place, upward = going[inside], place[inside], upward[inside]
        by_mean = apart(mean, own_mean, going, place)
        near = by_mean <= best[going]
        going, place, upward, by_mean = going[near], place[near], upward[near], by_mean[near]
        above[going] += upward
        below[going] -= ~upward
        close = by_mean + apart(deviation, own_deviation, going, place) <= best[going]
        rows, numbers = going[close], order[place[close]]
        computed += len(rows)
        distance = ((vectors[rows] - centroids[numbers]) ** 2).sum(axis=1)
        better = (distance < best[rows]) | ((distance == best[rows]) & (numbers < number[rows]))
        best[rows[better]], number[rows[better]] = distance[better], numbers[better]
    return number, best, computed


def component_limit(size: int) -> int:
    """Components below this have squared distances that fit 64 bits."""
    return math.isqrt((1 << 62) // max(size, 1)) // 2


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as rows of a matrix."""
    limit = component_limit(size)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            if len(flat) and np.abs(flat, dtype=np.int64).max() >= limit:
                raise ArithmeticError(f"a component of {limit} or more: squared distances would not fit 64 bits")
            yield part, flat.reshape(part.num_rows, size).astype(np.int64)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """(count, sum of components) of every centroid's vectors; a row a centroid and batch leaves a task."""
    size = centroids.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _matrices(batches, size):
            number, _, _ = nearest(rows, centroids)
            found = np.unique(number)
            sums = [rows[number == n].sum(axis=0) for n in found]
            counts = [int((number == n).sum()) for n in found]
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(found, pa.int32()), "n": pa.array(counts, pa.int64()), "sums": sums}
            )

    parts = vectors.select("vector").mapInArrow(partial, "cluster int, n bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[at].cast("decimal(38,0)")).alias(f"s{at}") for at in range(size)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect()  # one row a centroid
    return {row["cluster"]: (row["n"], [int(row[f"s{at}"]) for at in range(size)]) for row in rows}


def _seeds(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose hash of id and seed is smallest, in that order; equal ids by their components."""
    by_hash = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.select(by_hash.alias("hash"), "vector").orderBy(F.asc_nulls_last("hash"), "vector")
    return np.array([row["vector"] for row in first.limit(clusters).collect()], dtype=np.int64)


def integer_vector(vector: Column, size: int, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, held at the limit; null unless there are `size`, all finite."""
    limit = component_limit(size)

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    whole = (F.size(vector) == size) & F.forall(vector, finite)
    def scaled(x: Column) -> Column:
        return F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(limit)), F.lit(-limit)).cast("int")

    return F.when(whole, F.transform(vector, scaled))


def cluster(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    size: int = 64,
    seed: str = "3",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Two frames: (vec_id, cluster, distance) of the vectors, and (cluster, n, inertia, centroid), a row a cluster.

    Vectors of another size, null ones and those with a null or non-finite component are left
    out. Components become floor(1024 * x), and everything after that is exact: centroids are
    the componentwise floor of sum / count, a cluster that loses all its vectors keeps its
    centroid, and ties go to the smaller number. With fewer vectors than `clusters` there are
    as many clusters as vectors; without any, both frames are empty. Repeated rows count each;
    rows without an id are clustered too, but start a centroid only where there are too few
    others. Other columns are not looked at. A component of 2^27 or more (as an
    integer, with 64 of them) stops the job, as a squared distance might not fit a long.

    Each round is one narrow pass over the integers, written once, with the `clusters`
    centroids in its closure; a task sums its batches itself, so a shuffle carries a row for
    each batch and cluster, and one row a cluster reaches the driver.
    """
    whole = integer_vector(F.col(f"`{vector}`"), size)
    kept = vectors.select(F.col(f"`{vec_id}`").alias("id"), whole.alias("vector")).where("vector IS NOT NULL")
    kept = settle(kept, "vectors")
    centroids = _seeds(kept, clusters, seed).reshape(-1, size)
    spark = vectors.sparkSession
    if not len(centroids):
        nothing = kept.select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return nothing, spark.createDataFrame([], "cluster int, n bigint, inertia decimal(38,0), centroid array<bigint>")
    for _ in range(rounds):
        for number, (n, sums) in _sums(kept, centroids).items():
            centroids[number] = [total // n for total in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _matrices(batches, size):
            number, distance, _ = nearest(rows, centroids)
            columns = [part.column("id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    id_type = kept.schema["id"].dataType.simpleString()
    assigned = settle(kept.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance bigint"), "assigned")
    totals = assigned.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    )
    own = spark.createDataFrame(
        [(number, row.tolist()) for number, row in enumerate(centroids)], "cluster int, centroid array<bigint>"
    )
    found = own.join(totals, "cluster", "left").select(
        "cluster",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("inertia", F.lit(0).cast("decimal(38,0)")).alias("inertia"),
        "centroid",
    )
    return assigned, settle(found, "clusters")


def with_clusters(assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """The vectors with what is known of their cluster: its inertia, that of all, and the centroid's digest.

    A number of clusters is a parameter, so they are broadcast whatever the data.
    """
    total = clusters.agg(F.sum("inertia").alias("inertia")).first()["inertia"]
    own = clusters.select(
        "cluster",
        F.col("inertia").cast("bigint").alias("cluster_inertia"),
        F.lit(total).cast("bigint").alias("inertia"),
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return assigned.join(F.broadcast(own), "cluster").select(columns)
