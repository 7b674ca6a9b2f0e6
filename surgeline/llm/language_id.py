"""Language identification by cross-parsing.

For each language a suffix automaton is built over a bounded sample of its texts. A text is cut, from
left to right, into the longest phrases that occur in a language's sample; the fewer phrases a
language needs, the better it explains the text. Counts are normalised by the length of the text and
the size of the sample, since a larger sample makes longer phrases.

Sample: about ``DOCS`` texts per language, read whole; of all their fragments of ``FRAGMENT`` characters
about as many as make ``CHARS`` characters are drawn. Moves of an automaton are kept in a table with open
addressing, whose size depends on the sample alone and not on how many letters a script has; more than
``LANGUAGES`` languages are refused, which bounds what is broadcast.

Texts to be identified are read whole. A batch of texts walks an automaton in lockstep, each text in
lanes of ``LANE`` symbols; a lane whose predecessor ends inside a phrase is walked again from there until
it meets its earlier walk, so the phrases are those of the whole text.

Null texts and texts without a letter give ``und`` with score 0, ties the language that comes first;
with nothing to learn from every text is ``und``. Repeated rows, very long texts and further columns
are ordinary cases.
"""

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.llm.common import sliced, texts_of, with_column
from surgeline.llm.samples import bounded_sample
from surgeline.llm.sentencepiece_bpe import _extended
from surgeline.llm.textcodes import SPAN, code_points, tables
from surgeline.session import written

DOCS = 300
FRAGMENT = 250
CHARS = 40_000
LANGUAGES = 200  # of at most 8 MB each
LANE = 256
BLOCK = 32  # symbols after which a second walk of a lane is compared to the first
ROWS = 2048
STATE_BITS = 20  # an automaton has fewer states than 2 to this power
UNKNOWN = "und"
_SPACE = 0  # symbol of everything that is no letter


def suffix_automaton(symbols):
    """Moves (state, symbol, next state) of the suffix automaton of ``symbols``, as three arrays; 0 is its root."""
    follow, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    edges = np.array([(state, c, to) for state, moves in enumerate(follow) for c, to in moves.items()], np.int64).reshape(-1, 3)
    return edges.T


class Moves:
    """The moves of an automaton in a table with open addressing; at most a quarter of its slots are taken."""

    def __init__(self, edges, alphabet):
        state, symbol, to = edges
        if len(to) and to.max() >= 1 << STATE_BITS:
            raise ValueError("the sample of a language is too long")
        self.alphabet = alphabet
        self.bits = max(4, (4 * len(state)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int64)  # state and symbol, then the next state in the low bits
        self.root = np.full(alphabet, -1, np.int64)
        self.root[symbol[state == 0]] = to[state == 0]
        keys = state * alphabet + symbol
        at = self._at(keys)
        while len(keys):
            free = self.slot[at] < 0
            self.slot[at[free]] = (keys[free] << STATE_BITS) | to[free]  # of several takers the last one has it
            lost = self.slot[at] >> STATE_BITS != keys
            keys, to, at = keys[lost], to[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _at(self, keys):
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)

    def next(self, state, symbol):
        """Next state of each pair, -1 where there is none, and the places of those without one."""
        keys = state * self.alphabet + symbol
        at = self._at(keys)
        met = self.slot[at]
        out = met & ((1 << STATE_BITS) - 1)
        missed = np.flatnonzero(met >> STATE_BITS != keys)
        left = missed[met[missed] >= 0]  # another move has the slot
        out[missed] = -1
        if len(left):
            keys, at = keys[left], at[left]
            while len(left):
                at = (at + 1) & ((1 << self.bits) - 1)
                met = self.slot[at]
                same = met >> STATE_BITS == keys
                out[left[same]] = met[same] & ((1 << STATE_BITS) - 1)
                go = ~same & (met >= 0)
                left, keys, at = left[go], keys[go], at[go]
            missed = missed[out[missed] < 0]
        return out, missed


class Alphabet:
    """Symbols of the letters seen in training; one for spaces and all else, one for other letters, one for padding."""

    def __init__(self, letters):
        lower, letter, _ = tables()
        self.size = len(letters) + 3
        self.other, self.pad = self.size - 2, self.size - 1
        own = np.full(SPAN, self.other, np.int32)
        own[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.symbol = np.where(letter, own[lower], _SPACE).astype(np.int32)

    def read(self, texts):
        """Symbols of all texts with runs of spaces as one, and where each text begins."""
        code, bounds = code_points(texts)
        s = self.symbol[code]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != _SPACE) | (s[:-1] != _SPACE)
        keep[bounds[:-1][np.diff(bounds) > 0]] = True  # a text does not depend on the one before
        at = np.zeros(len(s) + 1, np.int64)
        np.cumsum(keep, out=at[1:])
        return s[keep], at[bounds]


class Model:
    def __init__(self, samples):
        """``samples``: language -> list of texts."""
        lower, letter, _ = tables()
        letters = set()
        for texts in samples.values():
            code, _ = code_points(texts)
            letters |= {chr(c) for c in np.unique(lower[code[letter[code]]]).tolist()}
        self.languages = sorted(samples)
        self.letters = sorted(letters)
        self.alphabet = Alphabet(self.letters)
        a = self.alphabet
        self.moves, self.cost = [], []
        for lang in self.languages:
            symbols, _ = a.read([" ".join(samples[lang])])
            self.moves.append(Moves(suffix_automaton(symbols.tolist()), a.size))
            self.cost.append(np.log2(max(2, len(symbols))))

    def _walk(self, block, state, moves):
        """State after the symbols of ``block`` (one row per step) and phrases that end on the way."""
        count = np.zeros(block.shape[1], np.int32)
        for symbols in block:
            to, missed = moves.next(state, symbols)
            symbols, before = symbols[missed], state[missed]
            pad, fresh = symbols == self.alphabet.pad, moves.root[symbols]
            # the phrase under way ends; a symbol the sample has nowhere is a phrase by itself
            count[missed] += ~pad * ((before > 0).astype(np.int32) + (fresh < 0))
            to[missed] = np.where(pad, before, np.maximum(fresh, 0))
            state = to
        return state, count

    def phrases(self, lanes, moves, first=None):
        """Phrases of each lane; ``lanes``: one row per step. ``first`` marks the lanes that begin a text, all by default.

        A phrase that runs across lanes counts in the lane in which it ends.
        """
        steps, n = lanes.shape
        first = np.ones(n, bool) if first is None else first
        cuts = list(range(0, steps, BLOCK))
        state = np.zeros((len(cuts) + 1, n), np.int64)  # before each block, and at the end
        count = np.zeros((len(cuts) + 1, n), np.int32)
        todo = np.arange(n)
        again = False
        while len(todo):
            live = todo
            for k, at in enumerate(cuts):
                to, ended = self._walk(lanes[at : at + BLOCK, live], state[k, live], moves)
                ended += count[k, live]
                met = again & (to == state[k + 1, live])
                # from here on the lane goes as before, only the count differs
                count[k + 1 :, live[met]] += ended[met] - count[k + 1, live[met]]
                live, to, ended = live[~met], to[~met], ended[~met]
                state[k + 1, live], count[k + 1, live] = to, ended
                if not len(live):
                    break
            enter = np.where(first, 0, np.roll(state[-1], 1))
            todo = np.flatnonzero(enter != state[0])
            state[0, todo] = enter[todo]
            again = True
        last = np.append(first[1:], True) if n else first
        return count[-1] + (last & (state[-1] > 0))

    def predict(self, texts):
        """Language and score of each text."""
        a = self.alphabet
        s, bounds = a.read(texts)
        size = np.diff(bounds)
        real = np.add.reduceat(np.append(s != _SPACE, False), bounds[:-1]) * (size > 0) if len(texts) else size
        n_lanes = -(-size // LANE)
        owner = np.repeat(np.arange(len(texts)), n_lanes)
        begin = np.repeat(bounds[:-1] - LANE * (np.cumsum(n_lanes) - n_lanes), n_lanes) + LANE * np.arange(len(owner))
        end = bounds[1:][owner]
        first = np.diff(owner, prepend=-1) > 0
        at = begin[None, :] + np.arange(LANE)[:, None]
        lanes = np.where(at < end[None, :], s[np.minimum(at, max(0, len(s) - 1))], a.pad).astype(np.int64) if len(s) else np.zeros((LANE, 0), np.int64)
        bits = np.empty((len(self.languages), len(texts)))
        for k, moves in enumerate(self.moves):
            total = np.bincount(owner, self.phrases(lanes, moves, first), minlength=len(texts))
            bits[k] = total * self.cost[k] / np.maximum(size, 1)
        best = np.argmin(bits, axis=0)
        least = bits[best, np.arange(len(texts))]
        second = np.partition(bits, 1, axis=0)[1] if len(bits) > 1 else np.zeros(len(texts))
        score = np.where(least + second > 0, second / np.maximum(least + second, 1e-300), 1.0) if len(bits) > 1 else np.ones(len(texts))
        known = real > 0
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0)


def _fragments(batches, share):
    """Of each text the fragments that a seeded draw takes, a share of them by language."""
    for batch in sliced(batches, ROWS):
        got = []
        for lang, draw, t in zip(batch.column("lang").to_pylist(), batch.column("draw").to_pylist(), texts_of(batch, "text")):
            took = np.random.default_rng(draw % (1 << 63)).random(-(-len(t) // FRAGMENT)) < share[lang]
            got += [(lang, draw, i, t[i * FRAGMENT : (i + 1) * FRAGMENT]) for i in np.flatnonzero(took).tolist()]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], k) for c, k in enumerate(kinds)], names=["lang", "draw", "at", "text"])


def fit(df, text="text", lang="lang", id_col="doc_id"):
    """A model from labelled rows; None if there is none with a letter."""
    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sample, counts = bounded_sample(rows, lang, id_col, DOCS)
    if len(counts) > LANGUAGES:
        raise ValueError(f"{len(counts)} languages, at most {LANGUAGES} are supported")
    draw = F.xxhash64(F.col(id_col).cast("string"), F.lit(0))
    sample = written(sample.select(F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).alias("text")), "language-sample")
    pieces = sample.groupBy("lang").agg(F.sum(F.ceil(F.length("text") / FRAGMENT)).alias("n")).collect()  # a row per language
    share = {r["lang"]: min(1.0, CHARS / FRAGMENT / max(1, r["n"])) for r in pieces}
    got = sample.mapInArrow(lambda it: _fragments(it, share), "lang string, draw long, at int, text string").collect()  # about CHARS characters per language
    samples = {}
    _, letter, _ = tables()
    for r in sorted(got, key=lambda r: (r["lang"], r["draw"], r["text"], r["at"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    samples = {k: v for k, v in samples.items() if letter[code_points(v)[0]].any()}
    return Model(samples) if samples else None


def predict(df, model, text="text", out="lang_pred", score="score"):
    """``df`` with the language of each whole text and the score."""
    if model is None:
        return df.withColumns({out: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = df.sparkSession.sparkContext.broadcast(model)  # of at most LANGUAGES tables, whose size is that of their samples

    def run(batches):
        for batch in sliced(batches, ROWS):
            names, scores = shared.value.predict(texts_of(batch, text))
            yield with_column(with_column(batch, out, pa.array(names, pa.string())), score, pa.array(scores, pa.float64()))

    schema = _extended(df, out, T.StringType())
    missing = [f for f in schema.fields if f.name != score]
    if score in df.columns:
        schema = T.StructType([T.StructField(score, T.DoubleType()) if f.name == score else f for f in schema.fields])
    else:
        schema = T.StructType([*missing, T.StructField(score, T.DoubleType())])
    return df.mapInArrow(run, schema)
