import hashlib
import math

import numpy as np
import pytest

from tripcraft.llm import kmeans


def brute(rows, clusters, dims, scale=256, rounds=5, seed=2):
    """Plain loops over Python integers: rows (key, cluster, distance) and the centroids."""
    kept = [(k, [math.floor(scale * float(x)) for x in v]) for k, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]

    def hashed(r):
        return hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]

    centroids = [list(v) for _, v in sorted(kept, key=hashed)[:clusters]]

    def assign():
        out = []
        for k, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((k, far.index(min(far)), min(far), v))
        return out

    for _ in range(rounds if centroids else 0):
        found = assign()
        for c in range(len(centroids)):
            inside = [v for _, n, _, v in found if n == c]
            if inside:
                centroids[c] = [sum(x) // len(inside) for x in zip(*inside, strict=True)]
    return sorted((r[:3] for r in (assign() if centroids else [])), key=str), centroids


def run(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found, centroids = kmeans.cluster(frame, **sizes)
    return sorted((tuple(r) for r in found.collect()), key=str), centroids.tolist()


@pytest.mark.parametrize("block", [7, 4096])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(kmeans, "ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(int(k), np.float32(rng.normal(size=8) * 0.3 + (k % 5)).tolist()) for k in range(200)]
    assert run(spark, rows, clusters=12, dims=8) == brute(rows, 12, 8)


def test_registered_query(spark, sf001):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()]
    out = kmeans.op13_clusters(spark, sf001).collect()
    found, centroids = brute(rows, 40, 64)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in out), key=str) == found
    for r in out:
        assert r.cluster_inertia == sum(d for _, c, d in found if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in found)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_edges(spark):
    """Nulls, wrong sizes, ties, repeated rows, a null key, fewer vectors than clusters, clashing columns, empty tables."""
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [-1.0, -0.3]), (3, None), (4, [1.0]), (5, []),
            (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("-inf"), 1.0]), (9, [0.5, 0.5]), (10, [-1e5, 1e5])]
    assert run(spark, rows, clusters=3, dims=2) == brute(rows, 3, 2)
    assert run(spark, rows, clusters=100, dims=2) == brute(rows, 100, 2)
    assert run(spark, rows[5:8], clusters=3, dims=2)[0] == []
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, k int, v string, cluster int")
    assert sorted((tuple(r) for r in kmeans.cluster(frame, clusters=3, dims=2)[0].collect()), key=str) == brute(rows, 3, 2)[0]
    empty, centroids = kmeans.cluster(frame.limit(0), clusters=3, dims=2)
    assert empty.count() == 0 and len(centroids) == 0 and kmeans.described(empty, centroids).count() == 0


def test_ties_go_to_the_smaller_centroid():
    values = np.array([-1, 1], dtype="<i8")
    block = {"ids": [1, 2], "sizes": [2], "values": values.tobytes(), "places": np.array([0, 1], dtype="<u2").tobytes()}
    cluster, distance = kmeans.nearest(block, np.array([[0], [0], [1]]))
    assert cluster.tolist() == [0, 2] and distance.tolist() == [1, 0]


def test_components_out_of_range_are_an_error(spark):
    assert kmeans.whole(np.array([[1e5]]), 256).tolist() == [[25_600_000]]
    with pytest.raises(ValueError, match="64 bits"):
        kmeans.whole(np.array([[1e30]]), 256)
