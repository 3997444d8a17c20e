import hashlib
import math

import numpy as np
import pytest

from tidemark.llm.centroids import CentroidLists, clustered, with_inertia

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v string, distance string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in vectors], VECTORS).repartition(4)


def brute(vectors, k, rounds, width, scale):
    """Every vector against every centroid, in Python integers."""
    used = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in vectors
            if v is not None and len(v) == width and all(c is not None and np.isfinite(c) for c in v)]
    mark = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(used, key=lambda r: (mark(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in used:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    rows = [(i, *reversed(nearest(v))) for i, v in used]
    return [(i, n, d, sum(r[2] for r in rows if r[1] == n), sum(r[2] for r in rows),
             hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, n, d in rows]


@pytest.mark.parametrize("spread", [3, 1_000, 3_000_000_000])
def test_nearest_equals_all_comparisons(spread):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread, size=(40, 7))
    centroids[20:25] = centroids[3]  # ties go to number 3
    vectors = np.vstack([rng.integers(-spread, spread, size=(300, 7)), centroids])
    number, distance = CentroidLists(centroids).nearest(vectors)
    for v, n, d in zip(vectors.tolist(), number, distance):
        assert min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids.tolist())) == (d, n)


def test_walk_stops_before_all_centroids_are_met(monkeypatch):
    centroids = np.arange(40)[:, None] * np.full((1, 4), 100)
    lists, compared = CentroidLists(centroids), []
    whole = np.flatnonzero
    monkeypatch.setattr(np, "flatnonzero", lambda m: compared.append(whole(m)) or compared[-1])
    number, distance = lists.nearest(np.array([[1_203, 1_199, 1_201, 1_200]]))
    assert (number[0], distance[0]) == (12, 9 + 1 + 1)
    assert len(set(np.concatenate(compared).tolist())) < 5


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(6, 8))
    vectors = [(i, (middle[i % 6] + rng.normal(size=8) / 3).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(300 + i, vectors[7][1]) for i in range(150)]                     # a third are copies
    vectors += [vectors[11], vectors[11], (12, vectors[13][1])]                   # repeated rows, an id with two vectors
    vectors += [(None, vectors[3][1]), (900, None), (901, []), (902, [1.0] * 7), (903, [1.0] * 7 + [None]),
                (904, [float("nan")] * 8), (905, [float("inf")] + [0.0] * 7)]
    found = with_inertia(clustered(frame(spark, vectors), k=12, rounds=3, width=8, scale=16))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(vectors, 12, 3, 8, 16), key=repr)


def test_few_vectors_none_and_very_large_components(spark):
    assert with_inertia(clustered(frame(spark, []))).collect() == []
    assert with_inertia(clustered(frame(spark, [(1, None), (2, [1.0])]))).collect() == []
    few = [(1, [0.5, -0.5]), (2, [3.0, 4.0])]
    found = with_inertia(clustered(frame(spark, few), width=2))
    assert sorted(map(tuple, found.collect())) == sorted(brute(few, 40, 5, 2, 256))
    large = [(i, [(-1.0) ** i * 1e30, float(i)]) for i in range(6)]
    rows = clustered(frame(spark, large), k=2, width=2).rows.collect()
    assert len(rows) == 6 and len({r.cluster for r in rows if r.vec_id % 2}) == 1


def test_copies_as_centroids(spark):
    same = [(i, [1.0, 2.0]) for i in range(60)]
    found = with_inertia(clustered(frame(spark, same), width=2)).collect()
    assert len(found) == 60 and {(r.cluster, r.distance, r.inertia) for r in found} == {(0, 0, 0)}
