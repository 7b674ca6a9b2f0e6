"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample of the vectors and large clusters are split, so that posting
lists come out even. Every vector goes to its nearest centroid and, if it lies near a boundary, to all
others that are almost as near. The centroids are linked to a graph that is held in memory; a beam
search on it finds the lists of a vector, both for filling and for asking. A query asks the lists
whose centroid is at most ``1 + RATIO`` times as far as the nearest one, and vectors in them are scored
exactly, by cosine in double precision.

Equal vectors are found once: of each group only the smallest ids can be among the nearest, so a
group is kept as one vector with as many ids as a result can need, found in two salted steps. A list that
is still long is cut into blocks of about ``BLOCK`` vectors, which are asked by separate tasks.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part, neither as query nor as candidate. Ties go to the smaller id. With fewer candidates than asked
for, all that were found come back. A repeated id counts as one candidate per distinct vector.
"""

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.session import written

SAMPLE = 40_000  # vectors that the centroids are fitted on, at most
LIST = 128  # vectors per centroid wanted
MAX_LISTS = 4096
SPLIT = 2.0  # a cluster of the sample larger than this times the mean is split
DEGREE = 24  # links of a centroid
BEAM = 64  # centroids that a search keeps, and so the most lists of a query
REPLICA_RATIO = 0.10
REPLICAS = 8
RATIO = 0.30
BLOCK = 4000


def usable(df, vector="embedding"):
    """Rows whose vector can take part."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    nonzero = F.exists(v, lambda x: x != 0)
    rows = df.filter(v.isNotNull() & (F.size(v) > 0)).filter(~odd & nonzero)
    sizes = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size(v) == sizes[0]["n"]) if sizes else rows


def distinct_vectors(df, need, id_col="vec_id", vector="embedding", salts=16):
    """Each distinct vector with its ``need`` smallest ids: rep (the smallest), ids, v."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    for keys in (["v", "salt"], ["v"]):
        w = Window.partitionBy(*keys).orderBy("id")
        rows = rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= need)
    grouped = rows.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select(F.element_at("ids", 1).alias("rep"), "ids", "v")


def unit(x):
    """Rows of unit length; scaled first, so that no square over- or underflows."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _nearest(x, centers, block=2048):
    return np.concatenate([np.argmax(x[i : i + block] @ centers.T, axis=1) for i in range(0, len(x), block)])


def _lloyd(x, k, rng, rounds):
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(x, centers)
        total = np.zeros_like(centers)
        np.add.at(total, own, x)
        norm = np.sqrt((total * total).sum(1))
        centers = np.where(norm[:, None] > 1e-12, total / np.maximum(norm, 1e-12)[:, None], centers)
    return centers


class Graph:
    """Centroids and their links."""

    def __init__(self, sample, lists, seed=7):
        x, rng = unit(sample), np.random.default_rng(seed)
        lists = max(1, min(lists, len(x)))
        centers = _lloyd(x, lists, rng, 8)
        for _ in range(3):
            own = _nearest(x, centers)
            count = np.bincount(own, minlength=len(centers))
            big = np.flatnonzero(count > SPLIT * len(x) / len(centers))
            new = []
            for b in big.tolist():
                part = x[own == b]
                two = _lloyd(part, 2, rng, 5) if len(part) > 2 else part
                new.append(two)
            if not new:
                break
            centers = np.concatenate([np.delete(centers, big, axis=0), *new])
        centers = np.unique(centers, axis=0)
        self.centers = centers.astype(np.float32)
        k, degree = len(centers), min(DEGREE, len(centers))
        near = [np.argpartition(-(centers[i : i + 512] @ centers.T), degree - 1, axis=1)[:, :degree] for i in range(0, k, 512)]
        links = np.concatenate(near).astype(np.int32)
        # some links into the distance keep every part of the graph in reach
        self.links = np.concatenate([links, rng.integers(0, k, (k, 4), dtype=np.int32)], axis=1)
        self.entry = np.linspace(0, k - 1, min(k, 32)).astype(np.int32)

    def search(self, x, beam):
        """For unit vectors: the ``beam`` nearest centroids that the search meets, nearest first, and distances."""
        k = len(self.centers)
        beam = min(beam, k)
        x = x.astype(np.float32)
        n = len(x)
        rows = np.arange(n)[:, None]
        best = np.broadcast_to(self.entry, (n, len(self.entry)))
        sim = x @ self.centers[self.entry].T
        expanded = np.zeros((n, k), bool)
        seen = np.zeros((n, k), bool)
        seen[:, self.entry] = True
        while True:
            todo = ~expanded[rows, best] & ~np.isneginf(sim)
            # the four nearest that were not followed yet
            order = np.argsort(np.where(todo, -sim, np.inf), axis=1)[:, :4]
            live = np.take_along_axis(todo, order, 1)
            if not live.any():
                break
            pick = np.take_along_axis(best, order, 1)
            r, c = np.nonzero(live)
            expanded[r, pick[r, c]] = True
            found = self.links[pick].reshape(n, -1)
            found = np.sort(found, axis=1)
            fresh = ~seen[rows, found] & (np.diff(found, axis=1, prepend=-1) != 0) & np.repeat(live.any(1), found.shape[1]).reshape(n, -1)
            seen[rows, found] = True  # a row without anything to follow is done
            score = np.full(found.shape, -np.inf, np.float32)
            r, c = np.nonzero(fresh)
            score[r, c] = np.einsum("ij,ij->i", x[r], self.centers[found[r, c]])
            best = np.concatenate([best, found], axis=1)
            sim = np.concatenate([sim, score], axis=1)
            keep = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
            best, sim = np.take_along_axis(best, keep, 1), np.take_along_axis(sim, keep, 1)
        distance = np.sqrt(np.maximum(0.0, 2 - 2 * sim))
        return best, np.where(np.isneginf(sim), np.inf, distance)


def _lists(df, graph, ratio, most, out):
    """Rows of ``df`` (rep, ids, v) for each list within the distance ratio."""
    shared = df.sparkSession.sparkContext.broadcast(graph)  # at most about MAX_LISTS centroids

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                v = part.column("v")
                x = unit(v.flatten().to_numpy().reshape(len(v), -1))
                best, distance = shared.value.search(x, most if most < BEAM // 2 else BEAM)
                near = distance <= (1 + ratio) * distance[:, :1] + 1e-7
                near[:, most:] = False
                near[:, 0] = True
                r, c = np.nonzero(near)
                taken = part.take(pa.array(r))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(best[r, c].astype(np.int32))], names=[*taken.schema.names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.IntegerType())]))


def _top(ids, queries, q_ids, vectors, own, k):
    """The ``k`` best distinct vectors of a block for each query."""
    sim = unit(queries) @ unit(vectors).T
    m = min(k, sim.shape[1])
    part = np.argpartition(-sim, m - 1, axis=1)[:, :m] if m < sim.shape[1] else np.broadcast_to(np.arange(m), sim.shape)
    # all that tie with the last one stay in, so that ties can go to the smaller id
    last = np.take_along_axis(sim, part, 1).min(1)
    r, c = np.nonzero(sim >= last[:, None] - 1e-12)
    return r, c


def cosine(a, b):
    """Row by row, on the original vectors, in double precision."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def nearest(df, is_query, k=5, id_col="vec_id", vector="embedding", ratio=RATIO, lists=None):
    """The ``k`` nearest found for every row where ``is_query`` holds: query_id, rank, vec_id, score."""
    need = k + 1
    rows = usable(df, vector)
    vectors = written(distinct_vectors(rows, need, id_col, vector), "ann-vectors")
    asked = rows.filter(is_query).select(F.col(id_col).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    n = vectors.count()
    result = "query_id long, rank int, vec_id long, score double"
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([], result)
    scale = 1 << 30
    share = min(scale, -(-scale * SAMPLE // n))
    sample = vectors.filter(F.pmod(F.xxhash64("rep"), F.lit(scale)) < share).select("v").toArrow().column("v")
    sample = sample.combine_chunks()
    sample = sample.flatten().to_numpy().reshape(len(sample), -1) if len(sample) else np.array([vectors.first()["v"]])
    graph = Graph(sample[: 2 * SAMPLE], lists or min(MAX_LISTS, max(1, n // LIST)))
    posted = written(_lists(vectors, graph, REPLICA_RATIO, REPLICAS, "list"), "ann-lists")
    sizes = posted.groupBy("list").count().select("list", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    sizes = written(sizes, "ann-sizes")  # a row per list
    posted = posted.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # equal queries are asked once, by the vector's smallest id
    queries = vectors.join(asked.select("v").distinct(), "v", "left_semi").select(F.col("rep").alias("q"), F.col("v"))
    probes = _lists(queries, graph, ratio, BEAM, "list").join(F.broadcast(sizes), "list")
    probes = probes.select("q", F.col("v").alias("qv"), "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def search(left, right):
        if not len(left) or not len(right):
            none = {"q": np.empty(0, np.int64), "rep": np.empty(0, np.int64), "ids": np.empty(0, object), "score": np.empty(0)}
            return pd.DataFrame(none)
        v = np.stack(right["v"].to_numpy())
        parts = []
        for at in range(0, len(left), 1024):
            qs = np.stack(left["qv"].to_numpy()[at : at + 1024])
            r, c = _top(None, qs, None, v, None, need)
            parts.append(pd.DataFrame({"q": left["q"].to_numpy()[at : at + 1024][r], "rep": right["rep"].to_numpy()[c], "ids": right["ids"].to_numpy()[c], "score": cosine(qs[r], v[c])}))
        return pd.concat(parts)

    keys = ["list", "block"]
    found = probes.groupBy(*keys).cogroup(posted.select("rep", "ids", "v", *keys).groupBy(*keys)).applyInPandas(
        search, "q long, rep long, ids array<long>, score double"
    )
    found = found.dropDuplicates(["q", "rep"])  # a vector may stand in several lists
    best = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    found = found.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= need)
    found = written(found.select("q", F.explode("ids").alias("vec_id"), "score"), "ann-found")
    asked_by = asked.join(vectors.select(F.col("rep").alias("q"), "v"), "v").select("query_id", "q")
    full = asked_by.join(found, "q").filter(F.col("query_id") != F.col("vec_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = full.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
