"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes one flat array of symbols, cut into words where a piece can never reach across (before
a word marker that follows another character). Per word the best-ranked adjacent pair is found with a
segmented minimum; all its leftmost, non-overlapping occurrences are merged in every word at once and
the array is compacted, until no pair is left. Words seen before in a task come from a bounded memo.

Nulls are read as empty texts and give an empty list of ids; repeated rows, empty tables and further
columns pass through. Very long texts go through in windows cut at word bounds, so memory is bounded
by the longest word and the list of ids of one row.
"""

import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from pyspark.sql import types as T

from surgeline.llm.common import sliced, texts_of, with_column

MARK = "▁"
WINDOW = 1 << 20  # characters of one text looked at together
MEMO = 150_000  # words remembered by a task
ROWS = 256  # rows of an Arrow batch turned into Python objects together
LONG_WORD = 2048  # symbols; a longer word is merged with a heap, whose cost is not quadratic
NONE = np.iinfo(np.int32).max
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6


class Vocabulary:
    """Pieces, ranks and the table of pairs that may merge."""

    def __init__(self, path):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without text normalisation are supported")
        self.dummy_prefix = norm.add_dummy_prefix
        self.fallback = spec.byte_fallback
        pieces = [(i, p.piece, p.score, p.type) for i, p in enumerate(model.pieces)]
        if any(t == _NORMAL and MARK in p.lstrip(MARK) for _, p, _, t in pieces) or any(t == 4 for *_, t in pieces):
            raise ValueError("pieces that reach across words or user-defined symbols are not supported")
        self.unknown = next(i for i, _, _, t in pieces if t == _UNKNOWN)
        self.ids = {p: i for i, p, _, t in pieces if t == _NORMAL}
        order = sorted({-s for _, _, s, t in pieces if t == _NORMAL})
        rank_of = {-s: r for r, s in enumerate(order)}
        self.rank = {p: rank_of[s] for _, p, s, t in pieces if t == _NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, p, _, t in pieces if t == _BYTE}
        self.surface = [p if t == _NORMAL else " ⁇ " if t == _UNKNOWN else "" for _, p, _, t in pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        n = len(pieces)
        # characters that occur inside pieces only get a number of their own behind the ids
        self.symbol = dict(self.ids)
        self.text = [p for _, p, _, _ in pieces]
        for p in self.ids:
            for c in p:
                if c not in self.symbol:
                    self.symbol[c] = len(self.text)
                    self.text.append(c)
        self.rest = len(self.text)  # the symbol of every other character
        by_rank = {}
        for p in self.ids:
            by_rank.setdefault(self.rank[p], []).append(p)
        unsafe = {r for r, ps in by_rank.items() if len(ps) > 1}
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is None or b is None:
                    continue
                pairs[a * (self.rest + 1) + b] = (self.rank[p], i)
                # a part that ranks behind the whole: merging one occurrence may open a better pair
                for part in (p[:k], p[k:]):
                    if self.rank.get(part, -1) > self.rank[p]:
                        unsafe.add(self.rank[part])
        self._index(pairs)
        self.unsafe = np.zeros(len(order) + 1, bool)
        self.unsafe[list(unsafe)] = True
        self.n = n

    def _index(self, pairs):
        """A table with open addressing, so that many pairs are looked up by a few gathers."""
        self.pairs = pairs
        self.bits = max(10, (4 * len(pairs)).bit_length())
        keys = np.array(list(pairs), np.int64)
        ranks, ids = np.array(list(pairs.values()), np.int32).reshape(-1, 2).T
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_rank = np.full(1 << self.bits, NONE, np.int32)
        self.slot_id = np.zeros(1 << self.bits, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = keys[left[free]]  # of several takers the last one has it
            won = self.slot_key[at] == keys[left]
            self.slot_rank[at[won]], self.slot_id[at[won]] = ranks[left[won]], ids[left[won]]
            left, at = left[~won], (at[~won] + 1) & ((1 << self.bits) - 1)
        cps = {ord(c): i for c, i in self.symbol.items() if len(c) == 1}
        self.of_char = np.full(0x110000, self.rest, np.int32)
        self.of_char[list(cps)] = list(cps.values())

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left, right):
        """Rank and merged id of the pairs; rank NONE where they don't merge."""
        key = left.astype(np.int64) * (self.rest + 1) + right
        at = self._slot(key)
        there = self.slot_key[at]
        off = np.flatnonzero((there != key) & (there >= 0))
        while len(off):
            at[off] = (at[off] + 1) & ((1 << self.bits) - 1)
            there = self.slot_key[at[off]]
            off = off[(there != key[off]) & (there >= 0)]
        return self.slot_rank[at], self.slot_id[at]

    def spelled(self, char):
        """Ids of a character that is no piece."""
        if self.fallback:
            return [self.bytes[b] for b in char.encode("utf-8")]
        return [self.unknown]


@lru_cache(maxsize=2)
def vocabulary(path):
    return Vocabulary(path)


def merge_words(vocab, words):
    """Ids of each word as int32 bytes, by merge rounds over all words together."""
    if not words:
        return []
    chars = "".join(words)
    code = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(w) for w in words], np.int64)
    sym = vocab.of_char[code]
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    origin = np.arange(len(chars), dtype=np.int32)
    final = np.full(len(chars), -1, np.int32)
    rank, merged = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)

    def refresh(at):
        """Rank anew the pairs that begin at these places."""
        at = at[(at >= 0) & (at + 1 < len(sym))]
        at = at[word[at] == word[at + 1]]
        rank[at], merged[at] = vocab.look(sym[at], sym[at + 1])

    refresh(np.arange(len(sym) - 1))
    while len(sym):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        best = np.minimum.reduceat(rank, first)
        length = np.diff(first, append=len(sym))
        keep = np.repeat(best < NONE, length)
        final[origin[~keep]] = sym[~keep]
        if not keep.any():
            break
        hit = np.flatnonzero((rank == np.repeat(best, length)) & keep)
        # runs of overlapping occurrences: every second one, from the left
        new_run = np.diff(hit, prepend=-2) != 1
        start = np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
        take = (np.arange(len(hit)) - start) % 2 == 0
        lone = vocab.unsafe[rank[hit]]
        take &= ~lone | (np.diff(word[hit], prepend=-1) != 0)  # a single merge in such words
        hit = hit[take]
        sym[hit] = merged[hit]
        rank[hit] = NONE
        keep[hit + 1] = False
        to = np.cumsum(keep) - 1
        sym, word, origin, rank, merged = sym[keep], word[keep], origin[keep], rank[keep], merged[keep]
        at = to[hit]
        rank[at] = NONE
        refresh(at)
        at = at - 1
        at = at[at >= 0]
        rank[at[word[at] == word[at + 1]]] = NONE
        refresh(at)
    used = final >= 0
    counts = np.add.reduceat(used, np.r_[0, np.cumsum(sizes)[:-1]]) if len(used) else sizes
    ends = np.cumsum(counts)
    flat = final[used]
    out, data = [], flat.tobytes()
    for e, c in zip(ends.tolist(), counts.tolist()):
        out.append(data[4 * (e - c) : 4 * e])
    if (flat >= vocab.n).any():  # words with characters that are no pieces are spelled out
        owner = np.repeat(np.arange(len(words)), counts)
        places = np.flatnonzero(used)
        for w in np.unique(owner[flat >= vocab.n]).tolist():
            ids = []
            for i in range(int(ends[w] - counts[w]), int(ends[w])):
                ids.extend([int(flat[i])] if flat[i] < vocab.n else vocab.spelled(chars[places[i]]))
            out[w] = np.array(ids, np.int32).tobytes()
    return out


def merge_long_word(vocab, word):
    """The same merges for one very long word, picked from a heap of pairs."""
    sym = [vocab.symbol.get(c, vocab.rest) for c in word]
    n = len(sym)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n
    pairs, base = vocab.pairs, vocab.rest + 1
    heap = []

    def offer(i):
        j = right[i]
        if j >= 0:
            got = pairs.get(sym[i] * base + sym[j])
            if got:
                heapq.heappush(heap, (got[0], i, sym[i], j, sym[j], got[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, j, b, merged = heapq.heappop(heap)
        if not (alive[i] and alive[j] and right[i] == j and sym[i] == a and sym[j] == b):
            continue
        sym[i], alive[j], right[i] = merged, False, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    out = []
    for i in range(n):
        if alive[i]:
            out.extend([sym[i]] if sym[i] < vocab.n else vocab.spelled(word[i]))
    return out


class Encoder:
    """Encodes texts; remembers the ids of up to ``MEMO`` words."""

    def __init__(self, path):
        self.vocab = vocabulary(path)
        self.memo = {}

    def _learn(self, words):
        """Put the new ones among the distinct ``words`` into the memo; returns those too long for it."""
        fresh = [w for w in words if w not in self.memo]
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
            fresh = list(words)
        short = [w for w in fresh if len(w) <= LONG_WORD]
        for w, ids in zip(short, merge_words(self.vocab, short)):
            self.memo[w] = ids
        return {w: np.array(merge_long_word(self.vocab, w), np.int32).tobytes() for w in fresh if len(w) > LONG_WORD}

    def _words(self, text):
        """Lists of words, a window of the text at a time."""
        text = text.replace(" ", MARK)
        if self.vocab.dummy_prefix:
            text = MARK + text
        at = 0
        while at < len(text):
            end = at + WINDOW
            if end < len(text):
                # the next place where a word begins
                found = re.compile(f"(?<=[^{MARK}]){MARK}").search(text, end)
                end = found.start() if found else len(text)
            yield _WORD.findall(text, at, end)
            at = end

    def encode(self, texts):
        """An array of ids for each text."""
        out = [None] * len(texts)
        batch, size = [], 0
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.empty(0, np.int32)
            elif len(t) + bool(self.vocab.dummy_prefix) > WINDOW:  # with the mark in front it may take a second window
                parts = []
                for words in self._words(t):
                    parts.extend(self._ids([words]))
                out[i] = np.concatenate(parts)
            else:
                batch.append((i, next(self._words(t))))
                size += len(t)
                if size > WINDOW:
                    self._flush(batch, out)
                    batch, size = [], 0
        self._flush(batch, out)
        return out

    def _flush(self, batch, out):
        for (i, _), ids in zip(batch, self._ids([w for _, w in batch])):
            out[i] = ids

    def _ids(self, lists):
        words = set(chain.from_iterable(lists))
        long = {} if self.memo.keys() >= words else self._learn(words)
        get = self.memo.get if not long else lambda w: long[w] if w in long else self.memo[w]
        return [np.frombuffer(b"".join(map(get, ws)), np.int32) for ws in lists]


@lru_cache(maxsize=2)
def encoder(path):
    """One encoder for all tasks of a worker, which keeps its memo."""
    return Encoder(path)


class Decoder:
    """Turns ids into the text the library gives for them."""

    def __init__(self, path):
        v = vocabulary(path)
        self.vocab = v
        self.pieces = [s.replace(MARK, " ") for s in v.surface]
        self.is_byte = np.zeros(v.n, bool)
        self.is_byte[list(v.byte_of)] = True

    def decode(self, ids):
        if not len(ids):
            return ""
        pieces = self.pieces
        byte = self.is_byte[ids]
        if not byte.any():
            text = "".join(map(pieces.__getitem__, ids.tolist()))
        else:
            parts, run = [], []
            for i, b in zip(ids.tolist(), byte.tolist()):
                if b:
                    run.append(self.vocab.byte_of[i])
                    continue
                if run:
                    parts.append(_from_bytes(run))
                    run = []
                parts.append(pieces[i])
            if run:
                parts.append(_from_bytes(run))
            text = "".join(parts)
        return text[1:] if self.vocab.dummy_prefix and text[:1] == " " else text


def _from_bytes(run):
    """UTF-8 text of a run of byte pieces; each byte that fits nowhere becomes U+FFFD."""
    data, out, at = bytes(run), [], 0
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        pass
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _extended(df, name, kind):
    fields = [f for f in df.schema.fields if f.name != name]
    order = [name if c == name else c for c in df.columns] + ([] if name in df.columns else [name])
    known = {f.name: f for f in fields} | {name: T.StructField(name, kind)}
    return T.StructType([known[c] for c in order])


def encode(df, model_path, text="text", out="ids"):
    """``df`` with the ids of each whole text in ``out`` (array<int>; null text: empty)."""

    def run(batches):
        for batch in sliced(batches, ROWS):
            ids = encoder(model_path).encode(texts_of(batch, text))
            offsets = np.zeros(len(ids) + 1, np.int64)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            if offsets[-1] < 2**31:
                array = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
            else:
                raise ValueError("set spark.sql.execution.arrow.maxRecordsPerBatch lower: too many ids in a batch")
            yield with_column(batch, out, array)

    return df.mapInArrow(run, _extended(df, out, T.ArrayType(T.IntegerType())))


def decode(df, model_path, ids="ids", out="decoded"):
    """``df`` with the text of each list of ids in ``out`` (null list: empty text)."""

    def run(batches):
        decoder = Decoder(model_path)
        for batch in sliced(batches, ROWS):
            column = batch.column(ids)
            texts = [decoder.decode(x.values.to_numpy(zero_copy_only=False) if x.is_valid else []) for x in column]
            yield with_column(batch, out, pa.array(texts, pa.string()))

    return df.mapInArrow(run, _extended(df, out, T.StringType()))


def recode(df, model_path, text="text", ids="ids", out="decoded"):
    """``df`` with ids and the text they decode to, in one pass: a task needs one Python worker and one vocabulary."""

    def run(batches):
        coder, decoder = encoder(model_path), Decoder(model_path)
        for batch in sliced(batches, ROWS):
            found = coder.encode(texts_of(batch, text))
            texts = pa.array([decoder.decode(x) for x in found], pa.string())
            lists = pa.array(found, pa.list_(pa.int32()))
            yield with_column(with_column(batch, ids, lists), out, texts)

    kinds = {ids: T.ArrayType(T.IntegerType()), out: T.StringType()}
    names = [*df.columns, *[c for c in kinds if c not in df.columns]]
    known = {f.name: f.dataType for f in df.schema.fields} | kinds
    return df.mapInArrow(run, T.StructType([T.StructField(c, known[c]) for c in names]))
