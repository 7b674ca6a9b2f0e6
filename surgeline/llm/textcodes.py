"""Texts of an Arrow batch as flat numpy arrays: code points and word hashes."""

import unicodedata
from functools import lru_cache

import numpy as np

SPAN = 0x110000
_P = np.uint64(0x100000001B3)


@lru_cache(maxsize=1)
def tables():
    """Per code point: its simple lower case, whether it is a letter, whether it belongs to a word."""
    lower = np.arange(SPAN, dtype=np.uint32)
    letter = np.zeros(SPAN, bool)
    word = np.zeros(SPAN, bool)
    for cp in range(SPAN):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind[0] == "L":
            letter[cp] = word[cp] = True
            if len(c.lower()) == 1:
                lower[cp] = ord(c.lower())
        elif kind[0] in "NM":
            word[cp] = True
    return lower, letter, word


def code_points(texts):
    """All texts in one array, and the place where each begins (one more place at the end)."""
    joined = "".join(texts)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def words(texts, stems=()):
    """Words are runs of letters, marks and digits, in lower case.

    Returns (hash, doc, start, end): a 64-bit hash for each word, its text's number, and its place in
    the text in code points. With ``stems``, lengths in characters, also for each length the hash of
    the first so many characters of every longer word and the number of its text.
    """
    code, bounds = code_points(texts)
    lower, _, is_word = tables()
    inside = is_word[code]
    doc_start = np.zeros(len(code) + 1, bool)
    doc_start[bounds] = True
    before = np.r_[False, inside[:-1]] if len(code) else inside
    first = np.flatnonzero(inside & (~before | doc_start[:-1]))
    if not len(first):
        none = np.empty(0, np.int64)
        found = np.empty(0, np.uint64), none, none, none
        return (*found, [(found[0], none) for _ in stems]) if stems else found
    after = np.r_[inside[1:], False]
    last = np.flatnonzero(inside & (~after | doc_start[1:]))
    size = last - first + 1
    flat = np.flatnonzero(inside)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    power = np.multiply.accumulate(np.full(int(size.max()), _P))
    term = (lower[code[flat]].astype(np.uint64) + np.uint64(1)) * power[place]
    value = mixed(np.add.reduceat(term, np.cumsum(size) - size))
    doc = np.searchsorted(bounds, first, side="right") - 1
    found = value, doc, first - bounds[doc], last + 1 - bounds[doc]
    if not stems:
        return found
    starts, cuts = np.cumsum(size) - size, []
    for k in stems:
        longer = np.flatnonzero(size > k)
        total = np.zeros(len(longer), np.uint64)
        for i in range(k):
            total += term[starts[longer] + i]
        cuts.append((mixed(total + np.uint64(k)), doc[longer]))
    return (*found, cuts)


def mixed(x):
    """A 64-bit finaliser, so that every bit of the input moves every bit of the output."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(value, doc, n):
    """Hash, text and first word of every run of ``n`` words within a text."""
    if len(value) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    total = value[: len(value) - n + 1].copy()
    for k in range(1, n):
        total = total * _P + value[k : len(value) - n + 1 + k]
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    return mixed(total[at]), doc[at], at
