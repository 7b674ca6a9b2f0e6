import random

import numpy as np
from pyspark.sql import functions as F

from surgeline.llm import ann

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.stack([v for _, v in ok])
    x = x / np.linalg.norm(x, axis=1)[:, None]
    ids = [i for i, _ in ok]
    out = {}
    for at, q in enumerate(ids):
        if q % 50 == 0:
            s = x @ x[at]
            out[q] = [ids[j] for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-round(s[j], 12), ids[j]))[:k]]
    return out


def search(spark, rows, **how):
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 0) for i, v in rows], KIND)
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, **how).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    return found


def test_recall_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(800)]
    rows += [(800 + i, [1.0, 2.0, 0, 0, 0, 0, 0, 0]) for i in range(400)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 8), (2150, [float("nan")] * 8), (2200, [None] + [1.0] * 7), (2250, [1.0, 2.0]), (2300, [float("inf")] * 8)]
    random.Random(1).shuffle(rows)
    got, want = search(spark, rows), brute(rows, 5)
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 5 * len(want)
    for q in range(800, 1200, 50):
        assert got[q] == want[q]  # all ties: the smallest ids but the own one


def test_few_and_no_vectors(spark):
    assert search(spark, [(0, [1.0] * 8), (1, [1.0] * 7 + [2.0]), (50, [2.0] * 8)]) == {0: [50, 1], 50: [0, 1]}
    assert search(spark, [(0, [1.0] * 8)]) == {}
    assert search(spark, []) == {}


def test_blocks_of_long_lists(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(300)]
    monkeypatch.setattr(ann, "BLOCK", 20)
    assert search(spark, rows, lists=2, ratio=9.0) == brute(rows, 5)


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(3)
    graph = ann.Graph(rng.normal(size=(4000, 16)), 200)
    x = ann.unit(rng.normal(size=(100, 16)))
    best, distance = graph.search(x, 40)
    true = np.argsort(-(x @ graph.centers.T), axis=1)[:, :10]
    assert np.mean([len(set(b[:10]) & set(t)) / 10 for b, t in zip(best.tolist(), true.tolist())]) > 0.9
    assert (np.diff(distance, axis=1) >= -1e-6).all()


def test_lists_that_nobody_asks(spark):
    """Well clustered vectors with few queries, so that most lists get none."""
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 8)) * 20
    rows = [(i * 7 + 1 if i else 50, [float(x) for x in (middle[i % 12] + rng.normal(size=8)).astype(np.float32)]) for i in range(900)]
    rows = [(i if i % 50 or n == 0 else i + 3, v) for n, (i, v) in enumerate(rows)]
    got, want = search(spark, rows, lists=40), brute(rows, 5)
    assert set(got) == {50} and len(set(got[50]) & set(want[50])) >= 4


def test_no_queries(spark):
    rng = np.random.default_rng(4)
    rows = [(50 * i + 1, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(300)]
    assert search(spark, rows) == {}
