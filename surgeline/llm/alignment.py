"""Alignment of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes (a space and the text) into tokens. Every token points to its farthest-right
overlapping token of the other tokenizer, one that ends where a token of the first ends to itself. Doubling the
successors of all tokens of a batch at once, until nothing moves, brings each to the last token of its component;
that token labels the group. Groups end where tokens of both end.

Three passes, each a Spark job over all documents: tokens are written once; pairs of overlapping tokens are
counted, added up inside each task before they are shuffled; then every document is measured against the counts.
Pairs in many documents are looked up in a table that is broadcast and holds ``LOOKUP`` pairs at most; links of all
other pairs are joined to their counts and added up by document.

Null and empty texts, and texts that one of the tokenizers doesn't give back byte by byte, have no tokens: all their
numbers are 0 and their digest is the empty string. Repeated rows are documents of their own; further columns are
not touched; an empty table gives an empty result.
"""

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from surgeline.llm.common import texts_of
from surgeline.session import new_path, written

LOOKUP = 1 << 20  # pairs that are broadcast, at most
SLICE = 1 << 20  # characters handled at once; a longer text is handled alone
PENDING = 1 << 21  # distinct pairs that a task holds before it passes them on
RUN = 1000  # longer runs without a change between space and text go to the slower library, with the same ids

# Fixed value: how the byte-level tokenizer splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols():
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else one above 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {chr(b if b in shown else next(hidden)): b for b in range(256)}


class Pieces:
    """The bytes of every token of a vocabulary."""

    def __init__(self, pieces):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.bytes = list(pieces)
        self.kind = np.uint16 if len(pieces) <= 1 << 16 else np.uint32

    def joined(self, ids):
        """The bytes of the tokens ``ids``, one after another."""
        return b"".join([self.bytes[i] for i in ids])


def may_run(text, run=RUN):
    """False only if no ``run`` characters in a row are all spaces or all others: such a run fills a block of half its length."""
    half = run // 2
    return len(text) >= run and any(text.find(" ", i, i + half) < 0 or text[i : i + half].isspace() for i in range(0, len(text) - half + 1, half))


@lru_cache(maxsize=2)
def byte_tokenizer(path):
    """encode(texts) and the pieces of a byte-level BPE tokenizer."""
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    symbols = byte_symbols()
    special = {t.content for t in slow.get_added_tokens_decoder().values()}
    pieces = [b""] * slow.get_vocab_size()
    for piece, i in slow.get_vocab().items():
        pieces[i] = piece.encode() if piece in special else bytes(symbols[c] for c in piece)
    ranks = {pieces[i]: i for p, i in model["vocab"].items() if p not in special}
    # ids in the order of the merges: then the rank of a merge is its token's id
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    quick = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if merged == list(range(256, 256 + len(merged))) else None
    long_run = re.compile(rf"\S{{{RUN}}}|\s{{{RUN}}}")

    def encode(texts):
        return [
            quick.encode_ordinary(t) if quick and not (may_run(t) and long_run.search(t)) else slow.encode(t, add_special_tokens=False).ids
            for t in texts
        ]

    return encode, Pieces(pieces)


@lru_cache(maxsize=2)
def piece_tokenizer(path):
    """encode(texts) and the pieces of a SentencePiece tokenizer."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]
    return (lambda texts: model.encode(texts, num_threads=1)), Pieces(pieces)


def by_length(texts, most=SLICE):
    """Numbers (a, b) of texts in a row that have about ``most`` characters together."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield a, i
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def tokens_of(texts, first, second):
    """Ids of both tokenizers for each text as arrays; without tokens where their bytes are not the text's."""
    (encode_a, a), (encode_b, b) = first, second
    out = []
    for t, x, y in zip(texts, encode_a([" " + t for t in texts]), encode_b(texts)):
        want = (" " + t).encode() if t else b""
        same = bool(t) and all(p.joined(i) == want for p, i in ((a, x), (b, y)))
        out.append(tuple(np.array(i if same else [], p.kind) for p, i in ((a, x), (b, y))))
    return out


def groups(end_a, end_b):
    """Group of every token of both, from the byte where each ends (rising; both end at the same last byte)."""
    na = len(end_a)
    over_a = np.searchsorted(end_b, end_a)  # the token of b that holds the last byte
    over_b = np.searchsorted(end_a, end_b)
    ends = end_a[over_b] == end_b if na else np.zeros(0, bool)
    to = np.concatenate([na + over_a, np.where(ends, na + np.arange(len(end_b)), over_b)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    number = np.cumsum(ends) - 1  # of the token that ends a component
    label = number[to - na] if na else to
    return label[:na], label[na:], int(ends.sum())


def links(end_a, size_a, end_b):
    """Numbers of the tokens of a and b whose bytes overlap."""
    first = np.searchsorted(end_b, end_a - size_a, side="right")
    n = np.searchsorted(end_b, end_a) - first + 1
    i = np.repeat(np.arange(len(end_a)), n)
    return i, np.arange(len(i)) + np.repeat(first - (np.cumsum(n) - n), n)


@lru_cache(maxsize=2)
def decimals(n):
    """Decimal digits of 0 to n - 1, from the left, and how many each has."""
    text = np.char.mod("%d", np.arange(n)).astype("S")
    return text.view(np.uint8).reshape(n, text.dtype.itemsize), np.char.str_len(text)


def digests(ids_a, ids_b, label_a, label_b, doc_a, doc_b, docs):
    """SHA-256 of `a1,a2|b1;a3|b2,b3` for each document: ids of each group, in order."""
    na, n = len(ids_a), len(ids_a) + len(ids_b)
    in_a, in_b = np.bincount(label_a), np.bincount(label_b)  # tokens of each group
    place_a = np.arange(na) + (np.cumsum(in_b) - in_b)[label_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(in_a)[label_b]
    ids, sep, doc = np.empty(n, np.int64), np.empty(n, np.uint8), np.empty(n, np.int64)
    for place, own, label, last, numbers in ((place_a, ids_a, label_a, b"|", doc_a), (place_b, ids_b, label_b, b";", doc_b)):
        ids[place], doc[place] = own, numbers
        sep[place] = np.where(np.diff(label, append=-1) != 0, last[0], ord(","))
    shown, size = decimals(int(ids.max(initial=0)) + 1 | 0xFFFF)
    size = size[ids]
    sep[np.diff(doc, append=-1) != 0] = 0
    width = shown.shape[1] + 1
    padded = np.empty((n, width), np.uint8)  # digits and separator of each token, zeros after them
    padded[:, :-1], padded[:, -1] = shown[ids], 0
    padded = padded.ravel()
    padded[np.arange(n) * width + size] = sep
    text = padded[padded != 0]
    used = np.concatenate([[0], np.cumsum(size + (sep != 0))])
    cut = used[np.searchsorted(doc, np.arange(docs + 1))]
    view = memoryview(text)
    return [hashlib.sha256(view[a:b]).hexdigest() if b > a else "" for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


class Flat:
    """Tokens of several documents in a row."""

    def __init__(self, column, pieces):
        value = [np.frombuffer(v, pieces.kind) for v in column.to_pylist()]
        self.n = np.array([len(v) for v in value], np.int64)
        self.ids = np.concatenate([*value, np.empty(0, pieces.kind)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(value)), self.n)
        self.size = pieces.size[self.ids]
        self.end = np.cumsum(self.size)


def _flat(batches, first, second):
    """Each batch in slices, with the flat tokens of both tokenizers."""
    for batch in batches:
        sizes = [len(v) for v in batch.column("a").to_pylist()]
        for x, y in by_length([range(s) for s in sizes]):
            part = batch.slice(x, y - x)
            yield part, Flat(part.column("a"), first), Flat(part.column("b"), second)


def _linked(a, b, width):
    """For every link of a slice: its document and its pair as one number."""
    i, j = links(a.end, a.size, b.end)
    return a.doc[i], a.ids[i] * width + b.ids[j]


def _added(keys, counts):
    """Counts by key, rising."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _counts(batches, first, second):
    """Documents of a task that hold each pair; passed on when there are very many pairs, and at the end."""
    width = len(second.size)
    span = len(first.size) * width
    held = np.empty(0, np.int64), np.empty(0, np.int64)
    for _, a, b in _flat(batches, first, second):
        doc, pair = _linked(a, b, width)
        pair = np.unique(pair + doc * span) % span  # documents of a slice times pairs stay below 2**63
        held = _added(np.concatenate([held[0], pair]), np.concatenate([held[1], np.ones(len(pair), np.int64)]))
        if len(held[0]) > PENDING:
            yield pa.RecordBatch.from_arrays([pa.array(h) for h in held], names=["pair", "n"])
            held = np.empty(0, np.int64), np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(h) for h in held], names=["pair", "n"])


OUT = "uid long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, rest array<long>"


def _measured(batches, first, second, table):
    """Numbers of each document; links whose pair is not in ``table`` come as ``rest``."""
    width = len(second.size)
    keys, counts, best = table
    for part, a, b in _flat(batches, first, second):
        label_a, label_b, _ = groups(a.end, b.end)
        doc, pair = _linked(a, b, width)
        n = part.num_rows
        at = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
        known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
        at, of = at[known], doc[known]
        total = np.zeros(n, np.int64)
        np.add.at(total, of, counts[at])
        ended = np.diff(label_b, append=-1) != 0
        rest = pair[~known]
        cut = np.searchsorted(doc[~known], np.arange(n + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("uid"), pa.array(a.n), pa.array(b.n), pa.array(np.bincount(b.doc[ended], minlength=n)), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(of[best[at]], minlength=n)), pa.array(total),
                pa.array(digests(a.ids, b.ids, label_a, label_b, a.doc, b.doc, n), pa.string()), pa.ListArray.from_arrays(pa.array(cut), pa.array(rest)),
            ],
            names=["uid", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest"],
        )


def _tokens(df, id_col, text, path_a, path_b):
    """uid, id and the ids of both tokenizers as binaries, written once."""
    source = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        first, second = byte_tokenizer(path_a), piece_tokenizer(path_b)
        for batch in batches:
            texts = texts_of(batch, "text")
            for x, y in by_length(texts):
                both = tokens_of(texts[x:y], first, second)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(x, y - x), *[pa.array([t[i].tobytes() for t in both], pa.binary()) for i in (0, 1)]], names=["id", "a", "b"]
                )

    rows = source.mapInArrow(run, f"id {kind}, a binary, b binary").withColumn("uid", F.monotonically_increasing_id())
    path = new_path(df.sparkSession, "alignment-tokens")
    rows.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def pair_counts(rows, path_a, path_b):
    """pair, n (documents that hold it), best (no pair of the same token of a has more)."""

    def run(batches):
        return _counts(batches, byte_tokenizer(path_a)[1], piece_tokenizer(path_b)[1])

    width = len(piece_tokenizer(path_b)[1].size)
    pairs = rows.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = written(pairs.withColumn("token", F.expr(f"pair div {width}")), "alignment-pairs")
    most = pairs.groupBy("token").agg(F.max("n").alias("most"))  # a row per token of the vocabulary
    return written(pairs.join(most, "token").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-counts")


def split_at(counts, limit=LOOKUP):
    """The least power of two such that at most ``limit`` pairs have that count or more (2**62: none has)."""
    by = sorted(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).count().collect(), reverse=True)  # 62 rows at most
    held, least = 0, 62
    for e, n in by:
        held += n
        if held > limit:
            break
        least = e
    return 1 << least


def align(df, path_a, path_b, id_col="doc_id", text="text", lookup=LOOKUP):
    """Tokens, groups, links, links to the best partner and the sum of their counts, for every document."""
    rows = _tokens(df, id_col, text, path_a, path_b)
    counts = pair_counts(rows, path_a, path_b)
    least = split_at(counts, lookup)
    table = counts.filter(F.col("n") >= least).toArrow()  # ``lookup`` pairs at most
    keys = table.column("pair").to_numpy()
    order = np.argsort(keys)
    table = keys[order], table.column("n").to_numpy()[order], table.column("best").to_numpy()[order].astype(bool)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        return _measured(batches, byte_tokenizer(path_a)[1], piece_tokenizer(path_b)[1], shared.value)

    out = written(rows.select("uid", "a", "b").mapInArrow(run, OUT), "alignment-documents")
    # pairs below ``least`` are in fewer documents than that, so no key of this join is hot
    rare = out.select("uid", F.explode("rest").alias("pair")).join(counts.filter(F.col("n") < least), "pair")
    rare = rare.groupBy("uid").agg(F.count_if("best").alias("more_best"), F.sum("n").alias("more_sum"))
    full = out.drop("rest").join(rare, "uid", "left").join(rows.select("uid", F.col("id").alias(id_col)), "uid")
    added = {c: (F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c) for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return full.select(id_col, "n_a", "n_b", "n_groups", "n_links", *added.values(), "groups_sha256")
