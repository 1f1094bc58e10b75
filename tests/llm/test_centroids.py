from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm.centroids import cluster, component_limit, nearest, with_clusters

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_force(vectors, centroids):
    """(distance, number) of each vector's nearest centroid in whole numbers."""
    return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids)) for v in vectors]


@pytest.mark.parametrize("spread", [2, 50, 2000, component_limit(7) - 1])
def test_nearest_is_brute_force_with_ties(spread):
    rng = np.random.default_rng(spread % 1000)
    for clusters in (1, 2, 8, 30):
        vectors = rng.integers(-spread, spread + 1, (400, 7))
        centroids = rng.integers(-spread, spread + 1, (clusters, 7))
        centroids[clusters // 2] = centroids[0]
        vectors[:clusters] = centroids
        number, distance, _ = nearest(vectors, centroids)
        want = brute_force(vectors.tolist(), centroids.tolist())
        assert list(zip(distance.tolist(), number.tolist())) == want


def test_large_offsets_and_small_deviations():
    rng = np.random.default_rng(5)
    offset = component_limit(64) - 10
    vectors = offset + rng.integers(-3, 4, (500, 64))
    centroids = offset + rng.integers(-3, 4, (8, 64))
    number, distance, _ = nearest(vectors, centroids)
    assert list(zip(distance.tolist(), number.tolist())) == brute_force(vectors.tolist(), centroids.tolist())


def test_bounds_spare_distances():
    rng = np.random.default_rng(6)
    levels = np.arange(16)[:, None] * 100
    centroids = levels + rng.integers(-5, 6, (16, 64))
    vectors = np.repeat(levels, 50, axis=0) + rng.integers(-5, 6, (800, 64))
    assert nearest(vectors, centroids)[2] < 2 * len(vectors)
    # Equal means, so the search goes in order: those after a vector's own are passed over by their deviation.
    signs = np.tile([1, -1], 32)
    centroids = (2 ** np.arange(8))[:, None] * signs
    vectors = np.repeat(centroids, 50, axis=0)
    assert nearest(vectors, centroids)[2] == 50 * sum(range(1, 9))


def whole_rounds(rows, clusters, rounds, size=64):
    """The contract, row by row."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == size and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(1024 * float(np.float32(x)))) for x in vector]))

    def place(row):
        return (row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest(), row[1])

    centroids = [vector for _, vector in sorted(kept, key=place)[:clusters]]
    for _ in range(rounds):
        found = brute_force([vector for _, vector in kept], centroids)
        for number in range(len(centroids)):
            own = [vector for (_, vector), (_, n) in zip(kept, found) if n == number]
            if own:
                centroids[number] = [sum(column) // len(own) for column in zip(*own)]
    found = brute_force([vector for _, vector in kept], centroids)
    inertia = {n: sum(d for d, m in found if m == n) for _, n in found}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (str(i), n, d, inertia[n], sum(inertia.values()), digests[n]) for (i, _), (d, n) in zip(kept, found)
    )


def result(rows):
    columns = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((str(row["vec_id"]), *[row[c] for c in columns]) for row in rows.collect())


def test_odd_vectors(spark):
    rng = random.Random(7)

    def vector(size=4, step=0.25):
        return [rng.randrange(-8, 9) * step for _ in range(size)]

    rows = [(i, vector()) for i in range(60)] + [(i, vector(step=0.0007)) for i in range(60, 80)]
    rows += [rows[3], rows[3], (4, vector()), (None, vector()), (None, None), (81, None), (82, []), (83, vector(3))]
    rows += [(84, vector(5)), (85, [1.0, None, 2.0, 3.0]), (86, [1.0, float("nan"), 2.0, 3.0])]
    rows += [(87, [1.0, float("inf"), 2.0, 3.0]), (88, [0.0, float("-inf"), 2.0, 3.0])]
    clash = {name: F.lit("clash") for name in ("id", "vector", "hash", "cluster", "distance", "n", "sums")}
    table = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS).withColumns(clash).repartition(5)
    got = with_clusters(*cluster(table, clusters=5, rounds=4, size=4))
    assert result(got) == whole_rounds(rows, 5, 4, 4)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 2.0])]
    table = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS)
    assert result(with_clusters(*cluster(table, clusters=8, rounds=3, size=2))) == whole_rounds(rows, 8, 3, 2)
    assigned, clusters = cluster(table, size=2)
    # Two equal seeds: the second has no vectors and keeps its place.
    assert sorted(row["n"] for row in clusters.collect()) == [0, 1, 2]
    assigned, clusters = cluster(table, size=9)
    assert with_clusters(assigned, clusters).collect() == [] and clusters.collect() == []


def test_components_beyond_the_limit_stop_the_job(spark):
    table = spark.createDataFrame([(1, [1e30, 0.0], None), (2, [0.0, 0.0], None)], VECTORS)
    with pytest.raises(Exception, match="would not fit 64 bits"):
        cluster(table, size=2)
