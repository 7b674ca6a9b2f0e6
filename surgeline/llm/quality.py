"""Quality by compression.

Two zstandard dictionaries are built, one from a sample of good and one from a sample of bad labelled
texts. A text is cut into pieces of 2 KB and each piece is compressed with either dictionary; the
dictionary that knows its wording gives the smaller result. The normalised difference of the summed
sizes, together with how far the text compresses at all (repetition), is turned into a probability by
a logistic fit on labelled texts that the dictionaries have not seen.

Samples: about ``DOCS`` texts of each label for the dictionaries, of each ``PIECES`` pieces from all over the
text, and as many for the fit, which are read whole, in tasks; only their features reach the driver. Texts that
are scored are read whole. Null and empty texts get the share of good labels;
with labels of one kind only, every text gets it. Repeated rows and further columns are ordinary cases.
"""

import numpy as np
import pyarrow as pa
import zstandard

from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.llm.common import sliced, texts_of, with_column
from surgeline.llm.samples import bounded_sample
from surgeline.llm.sentencepiece_bpe import _extended
from surgeline.session import written

DOCS = 1500
PIECE = 2048  # bytes compressed together
PIECES = 2  # pieces of a text that a dictionary may learn from
DICTIONARY = 48 << 10
LEVEL = 3
ROWS = 512


def pieces(text, seed=0):
    """(place, bytes) of ``PIECES`` pieces of a text, drawn from all its pieces."""
    data = text.encode("utf-8", "surrogatepass")
    n = -(-len(data) // PIECE)
    at = range(n) if n <= PIECES else np.random.default_rng(seed % (1 << 63)).choice(n, PIECES, replace=False).tolist()
    return [(i, data[i * PIECE : (i + 1) * PIECE]) for i in sorted(at)]


def _pieces(batches):
    for batch in sliced(batches, ROWS):
        got = [(y, d, i, p) for y, d, t in zip(batch.column("y").to_pylist(), batch.column("draw").to_pylist(), texts_of(batch, "text")) for i, p in pieces(t, d)]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], k) for c, k in enumerate(kinds)], names=["y", "draw", "at", "piece"])


def dictionary(parts):
    """A trained dictionary of the pieces, or their raw bytes where there is too little text to train one."""
    parts = [p for p in parts if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(parts)[-DICTIONARY:]


class Scorer:
    """Dictionaries and the calibration; what it holds can be pickled."""

    def __init__(self, good, bad, prior=0.5):
        self.good, self.bad, self.prior, self.weights = good, bad, prior, None

    def _tools(self):
        if not hasattr(self, "_compressors"):
            made = []
            for data in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(data)
                d.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
            self._compressors = made
        return self._compressors

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    def features(self, texts):
        """Per text: normalised difference of the compressed sizes, rate of compression, length."""
        good, bad = self._tools()
        out = np.zeros((len(texts), 3))
        for i, t in enumerate(texts):
            data = t.encode("utf-8", "surrogatepass")
            g = b = 0
            for at in range(0, len(data), PIECE):
                piece = data[at : at + PIECE]
                g += len(good.compress(piece))
                b += len(bad.compress(piece))
            if data:
                out[i] = (b - g) / max(b, g), np.log(min(b, g) / len(data)), np.log(len(data))
        return out

    @staticmethod
    def _expanded(f):
        d, r, n = f.T
        return np.column_stack([np.ones(len(f)), d, d * d, r, r * r, n, n * n, d * n, r * n, d * r])

    def calibrate(self, features, labels):
        """Logistic regression by Newton's method, with a small ridge, on the features of whole texts."""
        x, y = self._expanded(features), np.asarray(labels, float)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        self.mean[0], self.scale[0] = 0.0, 1.0
        x = (x - self.mean) / self.scale
        w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-2 * len(x) ** 0.5)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        return self

    def score(self, texts):
        if self.weights is None:
            return np.full(len(texts), self.prior)
        x = (self._expanded(self.features(texts)) - self.mean) / self.scale
        p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        return np.where([bool(t) for t in texts], p, self.prior)


def fit(df, text="text", label="quality", id_col="doc_id"):
    """A scorer from labelled rows (label 0 or 1)."""
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull() & (F.length(text) > 0))
    sample, counts = bounded_sample(rows, label, id_col, 2 * DOCS)
    draw = F.xxhash64(F.col(id_col).cast("string"), F.lit(0))
    sample = written(sample.select(F.col(label).cast("int").alias("y"), draw.alias("draw"), F.col(text).alias("text")), "quality-sample")
    n = sum(counts.values())
    prior = sum(v for k, v in counts.items() if int(k) == 1) / n if n else 0.5
    drawn = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if not drawn.get(0) or not drawn.get(1):
        return Scorer(b"", b"", prior)
    # half of the texts make the dictionaries, the others calibrate; with few texts all do both
    half = F.pmod(F.xxhash64("draw", F.lit(1)), F.lit(2)) == 0
    few = min(drawn[0], drawn[1]) < 20
    parts = (sample if few else sample.filter(half)).mapInArrow(_pieces, "y int, draw long, at int, piece binary").collect()
    by = {y: [bytes(r["piece"]) for r in sorted(parts, key=lambda r: (r["draw"], r["at"], bytes(r["piece"]))) if r["y"] == y] for y in (0, 1)}
    scorer = Scorer(dictionary(by[1]), dictionary(by[0]), prior)
    shared = df.sparkSession.sparkContext.broadcast(scorer)

    def measure(batches):
        for batch in sliced(batches, ROWS):
            f = shared.value.features(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("y"), *[pa.array(c) for c in f.T]], names=["y", "d", "r", "n"])

    got = (sample if few else sample.filter(~half)).mapInArrow(measure, "y int, d double, r double, n double").collect()
    got = np.array(sorted(tuple(r) for r in got))  # three numbers a text
    held = {y: int((got[:, 0] == y).sum()) if len(got) else 0 for y in (0, 1)}
    if not held[0] or not held[1]:
        return Scorer(b"", b"", prior)
    scorer.calibrate(got[:, 1:], got[:, 0])
    # the labels were drawn in other shares than they have
    share = held[1] / (held[0] + held[1])
    if 0 < prior < 1:
        scorer.weights[0] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return scorer


def score(df, scorer, text="text", out="score"):
    """``df`` with the probability of label 1 of each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)  # two dictionaries and ten weights

    def run(batches):
        for batch in sliced(batches, ROWS):
            yield with_column(batch, out, pa.array(shared.value.score(texts_of(batch, text)), pa.float64()))

    return df.mapInArrow(run, _extended(df, out, T.DoubleType()))
