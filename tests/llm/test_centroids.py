import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeline.llm import zone_maps


def brute(rows, k, rounds, size, seed, scale=256):
    """Plain rounds over Python integers: vec_id, vector -> vec_id, cluster, distance; centroids."""
    v = [(i, [int(np.floor(scale * float(np.float64(x)))) for x in e]) for i, e in rows
         if e is not None and len(e) == size and all(x is not None and np.isfinite(x) for x in e)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted((name(i), x) for i, x in v)[:k]]

    def own(x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        members = {}
        for _, x in v:
            members.setdefault(own(x)[0], []).append(x)
        centroids = [[sum(col) // len(members[c]) for col in zip(*members[c])] if c in members else old for c, old in enumerate(centroids)]
    return [(i, *own(x)) for i, x in v], centroids


def vectors(n, size, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(6, size))
    return [(i, (middle[rng.integers(6)] + 0.2 * rng.normal(size=size)).tolist()) for i in range(n)]


def check(spark, rows, k, rounds, size, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = zone_maps.cluster(df, k, rounds, size, 2, **more).collect()
    want, centroids = brute(rows, k, rounds, size, 2)
    assert sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance) for r in out) == sorted((i is None, i, c, d) for i, c, d in want)
    for r in out:
        assert r.inertia == sum(d for _, _, d in want)
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    return out


def test_equals_plain_rounds(spark):
    check(spark, vectors(500, 9), 7, 4, 9, block=32)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [1.0] * 8), (103, [None] * 9), (104, [nan] * 9), (105, [inf] + [0.0] * 8), (None, [0.5] * 9), (7, [0.5] * 9), (7, [0.5] * 9)]
    check(spark, vectors(60, 9) + odd, 5, 3, 9)
    check(spark, odd, 40, 5, 9)  # fewer vectors than centroids, all equal: ties go to the first, the others stay empty
    check(spark, [(i, [1.0] * 9) for i in range(300)] + vectors(50, 9), 4, 2, 9, block=16)
    assert zone_maps.cluster(spark.createDataFrame(odd[:6], "vec_id long, embedding array<double>"), 40, 5, 9, 2).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float((-1) ** i * (400_000 + i * 17 + j * 1000)) for j in range(4)]) for i in range(40)]
    check(spark, rows, 3, 2, 4)
    with pytest.raises(Exception, match="component reaches"):
        zone_maps.cluster(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"), 1, 1, 1).collect()


def test_names_of_columns_do_not_matter(spark):
    rows = vectors(80, 5)
    plain = zone_maps.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 4, 2, 5).collect()
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumns({n: F.lit("x") for n in ("key", "cluster", "ids", "low", "distance")})
    assert sorted(map(tuple, zone_maps.cluster(df, 4, 2, 5, id_col="id", vector="v").collect())) == sorted(map(tuple, plain))


def test_hilbert_neighbours_touch():
    """On a full grid the curve visits every cell once, each next to the one before."""
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = zone_maps.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_candidates_hold_every_nearest():
    rng = np.random.default_rng(1)
    for _ in range(50):
        v, c = rng.integers(-50, 50, (20, 3)), rng.integers(-60, 60, (12, 3))
        own, _ = zone_maps.nearest(v, c)
        assert set(own) <= set(zone_maps.candidates(v.min(0), v.max(0), c).tolist())
    tight = rng.integers(0, 3, (20, 3))
    assert len(zone_maps.candidates(tight.min(0), tight.max(0), np.array([[1, 1, 1], [90, 90, 90], [-80, 0, 0]]))) == 1
