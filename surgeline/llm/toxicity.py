"""Toxicity by FTRL-proximal logistic regression.

The features of a text are the hashed single words, word pairs, triples and skip-grams (two words
with one between) that occur in it, and the beginnings of its longer words, which inflected forms share. Learning runs in parallel: the labelled sample is dealt over a few
shards, each runs FTRL-proximal with a learning rate per coordinate and L1 shrinkage over its shard,
and the weights are averaged. L1 leaves few weights, so the model is small enough to broadcast (at most
``2 ** BITS`` weights).

Sample: at most about ``DOCS`` labelled texts, each read whole. Null and empty texts have no feature
but the constant one and get its score; without labels of both kinds every text gets their share.
Repeated rows, very long texts and further columns are ordinary cases.
"""

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.llm.common import sliced, texts_of, with_column
from surgeline.llm.samples import bounded_sample
from surgeline.llm.sentencepiece_bpe import _extended
from surgeline.llm.textcodes import mixed, words

BITS = 20
DOCS = 12_000
SHARD = 3_000  # labelled texts of a shard
PASSES = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
STEMS = (4, 5, 6)
ROWS = 256


def features(texts):
    """Hashed features of all texts and the text each belongs to; a feature may come repeatedly."""
    h, doc, _, _, stems = words(texts, STEMS)
    parts, owners = [h, *[x for x, _ in stems]], [doc, *[d for _, d in stems]]
    grams = (((0, 1), 1), ((0, 2), 2), ((0, 1, 2), 3))  # pairs, skip-grams, triples
    for offsets, salt in grams:
        reach = offsets[-1]
        n = max(0, len(h) - reach)
        total = np.full(n, np.uint64(salt * 7919))
        for o in offsets:
            total = total * np.uint64(0x9E3779B97F4A7C15) + h[o : o + n]
        same = np.flatnonzero(doc[:n] == doc[reach : reach + n])
        parts.append(total[same])
        owners.append(doc[same])
    index = (mixed(np.concatenate(parts)) >> np.uint64(64 - BITS)).astype(np.int64)
    return index, np.concatenate(owners)


def distinct_features(texts):
    """For each text its distinct features."""
    index, doc = features(texts)
    key = np.unique(doc << BITS | index)
    cut = np.searchsorted(key, np.arange(1, len(texts)) << BITS)
    return np.split((key & ((1 << BITS) - 1)).astype(np.int32), cut)


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the constant feature stands behind the hashed ones."""

    def __init__(self):
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at):
        z, n = self.z[at], self.n[at]
        shrunk = np.abs(z) - np.where(at == 1 << BITS, 0.0, L1)
        return np.where(shrunk > 0, -np.sign(z) * shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, found, y):
        at = np.append(found, 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[at]
        rate = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] = n + g * g


class Model:
    def __init__(self, index, weight, constant):
        self.index, self.weight, self.constant = index, weight, constant

    def dense(self):
        if not hasattr(self, "_dense"):
            self._dense = np.zeros(1 << BITS, np.float32)
            self._dense[self.index] = self.weight
        return self._dense

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_dense"}

    def score(self, texts):
        total = np.full(len(texts), self.constant)
        if len(self.index):
            index, doc = features(texts)
            known = self.dense()[index] != 0
            key = np.unique(doc[known] << BITS | index[known])  # a feature counts once for a text
            total += np.bincount(key >> BITS, self.dense()[key & ((1 << BITS) - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit(df, text="text", label="toxic", id_col="doc_id"):
    """A model from labelled rows (label 0 or 1)."""
    rows = df.filter(F.col(label).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("string"), F.lit(1)).alias("draw"), F.lit(1).alias("all"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("y"),
    )
    sample, counts = bounded_sample(rows, "all", "draw", DOCS)
    n = min(DOCS, sum(counts.values()))
    shards = max(1, round(n / SHARD))

    def run(table):
        """The weights that one shard learns; a shard holds a bounded share of the sample."""
        found = []
        for batch in sliced(table.to_batches(), ROWS):
            ys, draws = batch.column("y").to_pylist(), batch.column("draw").to_pylist()
            found.extend(zip(draws, ys, distinct_features(texts_of(batch, "text"))))
        found.sort(key=lambda r: (r[0], r[1], len(r[2])))
        model = Ftrl()
        for turn in range(PASSES):
            for _, y, x in found if turn % 2 == 0 else reversed(found):
                model.learn(x, y)
        w = model.weights(np.arange((1 << BITS) + 1))
        at = np.flatnonzero(w)
        return pa.table([pa.array(at), pa.array(w[at]), pa.array(np.full(len(at), len(found)))], names=["at", "w", "docs"])

    dealt = sample.select("draw", "text", "y", F.pmod("draw", F.lit(shards)).alias("shard"))
    # the shard is the group, so the model is the same for any number of partitions
    learned = dealt.groupBy("shard").applyInArrow(run, "at long, w double, docs long")
    # a shard without a weight for a feature counts with 0
    total = learned.groupBy("at").agg(F.sum(F.col("w") * F.col("docs")).alias("w"), F.sum("docs").alias("docs"))
    got = total.collect()  # at most 2 ** BITS + 1 rows, in practice what L1 leaves
    drawn = sum(r["docs"] for r in got if r["at"] == 1 << BITS) or n or 1
    table = sorted((r["at"], r["w"] / drawn) for r in got)
    constant = sum(w for at, w in table if at == 1 << BITS)
    kept = [(at, w) for at, w in table if at < 1 << BITS]
    return Model(np.array([at for at, _ in kept], np.int64), np.array([w for _, w in kept], np.float32), constant)


def score(df, model, text="text", out="score"):
    """``df`` with the probability of label 1 of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in sliced(batches, ROWS):
            yield with_column(batch, out, pa.array(shared.value.score(texts_of(batch, text)), pa.float64()))

    return df.mapInArrow(run, _extended(df, out, T.DoubleType()))
