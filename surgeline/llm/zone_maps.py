"""Centroid clustering over space-filling-curve zone maps.

Vectors become integers, are put into Hilbert order and cut into blocks of about ``BLOCK`` neighbours. A block keeps the least and
the greatest value of each component, its box. In each round the distance of every centroid to a box is bounded from
both sides; only centroids whose lower bound is not above the least upper bound can be the nearest of any vector
of the block, and only those are compared, exactly and for the whole block at once. A block with one candidate is
not compared at all: the sum of its vectors was stored with its box.

The curve runs through the ``AXES`` directions in which the first centroids differ most, ``LEVELS`` bits each: neighbours on it
tend to have the same candidates. It decides how much is compared and nothing else. Blocks are written once and read in every
round; a round returns one sum per centroid and component from each task, added up by Spark, so the driver holds as
many numbers as the centroids have.

Vectors that are null, of another length, or hold null or non-finite components take no part. Components
must stay below 2**LIMIT after scaling, so that squared distances fit 64 bits; a larger one stops the job. Repeated
vectors count each time; equal ids take their order among first centroids from the vector. With fewer
vectors than centroids there are as many centroids as vectors; an empty table gives an empty result.
"""

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from surgeline.session import written

BLOCK = 512
AXES = 8
LEVELS = 8
LIMIT = 27


def kept(df, size, id_col="vec_id", vector="embedding", scale=256):
    """id and the integer vector ``v`` of every row that can take part."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    # both sides of the test are needed, as neither filters null by itself
    rows = df.filter(v.isNotNull() & (F.size(v) == size)).filter(~odd).select(F.col(id_col).alias("id"), whole.alias("v"))
    wide = F.exists("v", lambda x: F.abs(x) >= F.lit(1 << LIMIT))
    return rows.withColumn("v", F.when(wide, F.raise_error(F.lit(f"a component reaches 2**{LIMIT} after scaling")).cast("array<long>")).otherwise(F.col("v")))


def first_centroids(rows, k, seed):
    """The ``k`` vectors whose seeded id has the least SHA-256, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    least = rows.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in least], np.int64)


def hilbert(x, bits):
    """Hilbert keys of points with ``bits`` bits per axis, as one unsigned number each (axes * bits up to 64).

    From the highest bit down every axis may exchange low bits with the first one or turn them around; the Gray code of
    what is left, taken across the axes, is the place on the curve.
    """
    x = np.array(x, np.uint64).T
    n = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - np.uint64(1)
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - np.uint64(1)), flip)
        q >>= np.uint64(1)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    return key


class Curve:
    """Directions in which the centroids differ most, cut into cells around their middle."""

    def __init__(self, centroids, axes=AXES, levels=LEVELS):
        c = centroids.astype(np.float64)
        self.middle = c.mean(axis=0)
        _, strength, directions = np.linalg.svd(c - self.middle, full_matrices=False)
        self.axes = directions[:axes]
        # the centroids' spread with as much again on both sides; what lies beyond falls into the outer cells
        self.reach = np.maximum(2 * np.abs((c - self.middle) @ self.axes.T).max(axis=0, initial=0), 1.0)
        self.levels = levels

    def keys(self, v):
        cells = 1 << self.levels
        at = ((v - self.middle) @ self.axes.T / self.reach + 1) / 2 * cells
        return hilbert(np.clip(np.floor(at), 0, cells - 1), self.levels)


def matrix(column):
    """A list column whose rows have the same length, as an array."""
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _keyed(batches, curve):
    for batch in batches:
        # keys rise as signed numbers too
        keys = (curve.keys(matrix(batch.column("v"))) ^ np.uint64(1 << 63)).view(np.int64) if batch.num_rows else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*batch.schema.names, "key"])


def _blocks(batches, size):
    """One row for each block: ids, vectors, box and sum."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            v = matrix(part.column("v"))
            box = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (v.min(axis=0), v.max(axis=0), v.sum(axis=0))]
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id"))
            yield pa.RecordBatch.from_arrays([ids, pa.array([v.astype(np.int32).tobytes()], pa.binary()), *box], names=["ids", "vectors", "low", "high", "total"])


def candidates(low, high, centroids):
    """Numbers of the centroids that can be the nearest of some point between ``low`` and ``high``."""
    below, above = low - centroids, centroids - high
    out = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    least, most = np.einsum("ij,ij->i", out, out), np.einsum("ij,ij->i", far, far)
    return np.flatnonzero(least <= most.min())


def nearest(v, centroids):
    """For each row the number of the nearest centroid (the smaller one of a tie) and the squared distance, exactly."""
    v, centroids = v.astype(np.int64), centroids.astype(np.int64)
    most = max(int(np.abs(v).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if v.shape[1] * (2 * most) ** 2 < 1 << 52:  # then every step is exact in double precision
        a, b = v.astype(np.float64), centroids.astype(np.float64)
        d = np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)
        d = d.astype(np.int64)
    else:
        d = np.stack([np.einsum("ij,ij->i", v - c, v - c) for c in centroids], axis=1)
    own = d.argmin(axis=1)
    return own, d[np.arange(len(v)), own]


def _opened(batch, centroids):
    """Of each block: its row, the candidates, and the vectors if there are several."""
    low, high = matrix(batch.column("low")), matrix(batch.column("high"))
    vectors = batch.column("vectors")
    for i in range(batch.num_rows):
        near = candidates(low[i], high[i], centroids)
        yield i, near, np.frombuffer(vectors[i].as_buffer(), np.int32).reshape(-1, centroids.shape[1])


def _sums(batches, centroids):
    """One row for each centroid that a task met: vectors and their sum."""
    count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    for batch in batches:
        whole = matrix(batch.column("total"))
        for i, near, v in _opened(batch, centroids):
            if len(near) == 1:
                count[near[0]] += len(v)
                total[near[0]] += whole[i]
            else:
                own, _ = nearest(v, centroids[near])
                count += np.bincount(near[own], minlength=len(count))
                np.add.at(total, near[own], v)
    met = np.flatnonzero(count)
    sums = pa.array([t.tolist() for t in total[met]], pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(count[met]), sums], names=["cluster", "n", "total"])


def _assigned(batches, centroids):
    for batch in batches:
        ids = batch.column("ids")
        for i, near, v in _opened(batch, centroids):
            own, d = nearest(v, centroids[near])
            yield pa.RecordBatch.from_arrays([ids[i].values, pa.array(near[own].astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"])


def moved(blocks, centroids):
    """The centroids after one round: the floor of the mean of their vectors; those without any stay."""
    shared = blocks.sparkSession.sparkContext.broadcast(centroids)
    parts = blocks.mapInArrow(lambda it: _sums(it, shared.value), "cluster int, n long, total array<long>")
    by = parts.select("cluster", "n", F.posexplode("total").alias("axis", "s")).groupBy("cluster", "axis").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = centroids.copy()
    for r in by.collect():  # as many rows as the centroids have numbers
        out[r["cluster"], r["axis"]] = r["s"] // r["n"]
    return out


def cluster(df, k, rounds, size, seed=0, id_col="vec_id", vector="embedding", scale=256, block=BLOCK):
    """Cluster and squared distance of every vector after ``rounds`` rounds, with the clusters' inertia and digest."""
    rows = written(kept(df, size, id_col, vector, scale), "zones-vectors")
    centroids = first_centroids(rows, k, seed)
    ids = dict(rows.dtypes)["id"]
    spark = df.sparkSession
    if not len(centroids):
        empty = f"{id_col} {ids}, cluster int, distance long, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string"
        return spark.createDataFrame([], empty)
    curve = spark.sparkContext.broadcast(Curve(centroids))
    keyed = rows.mapInArrow(lambda it: _keyed(it, curve.value), f"id {ids}, v array<long>, key long")
    keyed = written(keyed, "zones-keys")
    # equal vectors have equal keys: the id's hash cuts a large group of them
    ordered = keyed.repartitionByRange("key", F.xxhash64("id")).sortWithinPartitions("key").select("id", "v")
    shape = f"ids array<{ids}>, vectors binary, low array<long>, high array<long>, total array<long>"
    blocks = written(ordered.mapInArrow(lambda it: _blocks(it, block), shape), "zones-blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    shared = spark.sparkContext.broadcast(centroids)
    out = written(blocks.mapInArrow(lambda it: _assigned(it, shared.value), f"id {ids}, cluster int, distance long"), "zones-assigned")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r["cluster"]: r["s"] for r in inertia.collect()}  # a row per centroid
    table = [(c, inertia.get(c, Decimal(0)), sum(inertia.values(), Decimal(0)), d) for c, d in enumerate(digest)]
    known = spark.createDataFrame(table, "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    return out.join(F.broadcast(known), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
