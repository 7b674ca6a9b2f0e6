"""Benchmark decontamination by winnowing.

Of every window of ``WINDOW`` neighbouring runs of ``K`` words the run with the least hash is kept, so that a span of
``WINDOW + K - 1`` words that stands in a text and in a test item leaves the same fingerprint in both; an item with
fewer words is one run, kept whole. A text keeps only what the bitmap of the items' fingerprints lets through: it has
a fixed number of bits, so what is broadcast does not grow. Around each hit the spans that contain it are
extended word by word to the whole window, and windows are joined to those of the items by fingerprint and content
(two independent hashes of 64 bits over 64-bit word hashes).

Windows that stand in the same set of items form a class, and texts with the same set of classes a signature. Lists
of items are made once per signature, so neither a passage that many items share nor one that many
texts share is expanded into pairs of texts and items.

Words are runs of digits, ASCII letters and characters above U+007F; A-Z count as a-z. Null and empty texts have no
words and are clean; items without words are nowhere. Items with the same id count as one; an item without an id counts
under the empty id. Repeated rows are texts of their own; long texts are read whole; further columns are not touched.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import functions as F

from surgeline.llm.textcodes import mixed
from surgeline.session import written

K = 5  # words of a run
WINDOW = 6  # neighbouring runs of which the least is kept
SPAN = WINDOW + K - 1  # words of a window
BITS = 24  # the bitmap has 2**BITS bits: 2 MB
SLICE = 1 << 19  # bytes of text handled at once
SALTS = 32
SMALL = 100_000  # rows of a table that is broadcast; a larger one is spread over salts and shuffled

_P, _Q = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def byte_classes():
    """For each byte its lower case, and whether it belongs to a word."""
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 0x20
    word = np.zeros(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        word[a:b] = True
    return lower, word


def word_hashes(code, bounds):
    """Hash and text number of every word; ``code`` has the bytes of all texts, ``bounds`` where each begins."""
    lower, is_word = byte_classes()
    inside = is_word[code]
    edge = np.zeros(len(code) + 1, bool)
    edge[bounds] = True
    first = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | edge[:-1])) if len(code) else np.empty(0, np.int64)
    if not len(first):
        return np.empty(0, np.uint64), first
    last = np.flatnonzero(inside & (np.r_[~inside[1:], True] | edge[1:]))
    size = last - first + 1
    start = np.cumsum(size) - size
    flat = np.flatnonzero(inside)
    power = np.multiply.accumulate(np.full(int(size.max()), _P))
    term = (lower[code[flat]].astype(np.uint64) + np.uint64(1)) * power[np.arange(len(flat)) - np.repeat(start, size)]
    return mixed(np.add.reduceat(term, start) ^ size.astype(np.uint64)), np.searchsorted(bounds, first, side="right") - 1


def runs(value, doc, k, factor=_P):
    """Hash of every run of ``k`` words that lies in one text, and its first word."""
    if len(value) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = len(value) - k + 1
    total = value[:n].copy()
    for i in range(1, k):
        total = total * factor + value[i : n + i]
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mixed(total[at] + np.uint64(k)), at


def windows(value, doc):
    """Of every window of ``SPAN`` words: the fingerprint that it keeps, a hash of it all, its first word."""
    whole, at = runs(value, doc, SPAN, _Q)
    run = np.zeros(max(1, len(value)), np.uint64)
    run_hash, run_at = runs(value, doc, K)
    run[run_at] = run_hash
    least = np.full(len(at), np.iinfo(np.uint64).max, np.uint64)
    for i in range(WINDOW):
        least = np.minimum(least, run[at + i])
    return least, whole, at


def _texts(batches):
    """Each batch in slices, with the words of its texts: (slice, word hashes, text of each word)."""
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary())
        size = np.array([0 if v is None else v for v in pc.binary_length(column).to_pylist()], np.int64)
        upto = np.cumsum(size)
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SLICE, side="right")))
            part = column.slice(a, b - a)
            joined = b"".join(v for v in part.to_pylist() if v)
            bounds = np.r_[0, np.cumsum(size[a:b])]
            yield batch.slice(a, b - a), *word_hashes(np.frombuffer(joined, np.uint8), bounds)
            a = b


def _item_windows(batches):
    """Rows (item, size, mark, content): the windows of the items; an item of fewer words is one."""
    for batch, value, doc in _texts(batches):
        n = np.bincount(doc, minlength=batch.num_rows)
        parts = [(*windows(value, doc), SPAN)]
        for k in np.unique(n[(n > 0) & (n < SPAN)]).tolist():
            short = np.flatnonzero(n[doc] == k)
            mark, content, at = _short(value[short], doc[short], k)
            parts.append((mark, content, short[at], k))
        mark, content = (np.concatenate([p[i] for p in parts]).view(np.int64) for i in (0, 1))
        at = np.concatenate([p[2] for p in parts])
        size = np.concatenate([np.full(len(p[2]), p[3], np.int32) for p in parts])
        yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(doc[at])), pa.array(size), pa.array(mark), pa.array(content)], names=["item", "size", "mark", "content"])


def _short(value, doc, k):
    """Runs of ``k`` words, kept whole: a window of one run."""
    mark, at = runs(value, doc, k)
    return mark, runs(value, doc, k, _Q)[0], at


def bit_of(mark):
    """Place of a fingerprint in the bitmap, as a column."""
    return F.pmod(mark, F.lit(1 << BITS))


def bitmap(marks):
    """The bitmap of all fingerprints: at most 2**BITS / 64 rows reach the driver."""
    bits = marks.select(bit_of(F.col("mark")).alias("bit"))
    # a shift of one by 63 gives the sign bit, as wanted
    words = bits.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits")).toArrow()
    out = np.zeros((1 << BITS) // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


WINDOWS = "array<struct<size:int,mark:long,content:long,at:array<int>>>"


def _marked(batches, bits, shorter):
    """n_words and the windows whose fingerprint may be one of the items', for each text."""
    mask = np.uint64((1 << BITS) - 1)
    for batch, value, doc in _texts(batches):
        n = np.bincount(doc, minlength=batch.num_rows)
        begin = np.cumsum(n) - n
        parts = [(*windows(value, doc), SPAN), *[(*_short(value, doc, k), k) for k in shorter]]
        found = []
        for mark, content, at, size in parts:
            hit = bits[mark & mask]
            found.append((mark[hit], content[hit], at[hit], np.full(int(hit.sum()), size, np.int32)))
        mark, content, at, size = (np.concatenate([f[i] for f in found]) for i in range(4))
        of = doc[at] if len(at) else at
        # a row for each different window of a text, with all the places where it stands
        order = np.lexsort((at, size, content, mark, of))
        mark, content, at, size, of = mark[order], content[order], at[order], size[order], of[order]
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (mark[1:] != mark[:-1]) | (content[1:] != content[:-1]) | (size[1:] != size[:-1])
        first = np.flatnonzero(new)
        places = pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)].astype(np.int32)), pa.array((at - begin[of]).astype(np.int32) if len(at) else np.empty(0, np.int32)))
        rows = pa.StructArray.from_arrays([pa.array(size[first]), pa.array(mark[first].view(np.int64)), pa.array(content[first].view(np.int64)), places], ["size", "mark", "content", "at"])
        cut = np.searchsorted(of[first], np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.ListArray.from_arrays(pa.array(cut), rows)], names=["id", "n_words", "windows"])


KEY = ["size", "mark", "content"]


def set_hash(*cols):
    """A number for a set of rows that does not depend on their order: count, sum and exclusive or of their hashes."""
    h = F.xxhash64(*cols)
    return F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(F.xxhash64(F.lit(1), *cols))), 256)


def item_classes(items, item_id="item_id", text="text"):
    """Two tables: the windows of the items with their class, and the items of each class."""
    source = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    held = written(source.mapInArrow(_item_windows, "item string, size int, mark long, content long").distinct(), "leak-items")
    # an item that has a window is one row of it, so a set of items is known by sums, without being gathered
    sets = written(held.groupBy(*KEY).agg(set_hash("item").alias("class")), "leak-windows")
    shown = sets.groupBy("class").agg(F.min(F.struct(*KEY)).alias("k")).select("class", "k.*")
    return sets, written(held.join(shown, KEY).select("class", "item"), "leak-classes")


def met(left, right, keys, uid, small=SMALL):
    """``left`` joined to ``right``, which has one row for each value of ``keys``; any number of rows of ``left`` may share a value."""
    if right.count() <= small:
        return left.join(F.broadcast(right), keys)
    salted = left.withColumn("salt", F.pmod(F.xxhash64(uid), F.lit(SALTS)).cast("int"))
    spread = right.withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])))
    return salted.hint("shuffle_merge").join(spread, [*keys, "salt"]).drop("salt")


def covered(spans):
    """Words that lie in one span (start, end) or more, of a column of spans."""
    step = lambda acc, s: F.struct(
        (acc.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, acc.upto))).alias("n"), F.greatest(acc.upto, s.end).alias("upto")
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc.n)


def contamination(df, items, id_col="doc_id", text="text", item_id="item_id", item_text="text", small=SMALL):
    """Words of each text, those inside a window of an item, the items with such windows (count and sorted ids)."""
    sets, classes = item_classes(items, item_id, item_text)
    shorter = sorted(r["size"] for r in sets.filter(F.col("size") < SPAN).select("size").distinct().collect())  # SPAN - 1 at most
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(bitmap(sets)))
    source = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        return _marked(batches, np.unpackbits(shared.value).view(bool), shorter)

    texts = source.mapInArrow(run, f"id {kind}, n_words long, windows {WINDOWS}").withColumn("uid", F.monotonically_increasing_id())
    texts = written(texts, "leak-texts")
    hits = met(texts.select("uid", F.inline("windows")), sets, KEY, "uid", small)
    spans = F.flatten(F.collect_list(F.transform("at", lambda a: F.struct(a.alias("start"), (a + F.col("size")).alias("end")))))
    hits = written(hits.groupBy("uid").agg(spans.alias("spans"), F.collect_set("class").alias("classes")), "leak-hits")
    hits = hits.select("uid", covered(F.col("spans")).cast("long").alias("n_hit"), F.sort_array("classes").alias("classes"))
    hits = hits.withColumn("signature", F.sha2(F.array_join("classes", ","), 256))
    shown = hits.groupBy("signature").agg(F.min("classes").alias("classes"))
    listed = shown.select("signature", F.explode("classes").alias("class")).join(classes, "class").select("signature", "item").distinct()
    listed = listed.groupBy("signature").agg(F.sort_array(F.collect_list("item")).alias("items"))
    listed = written(listed.select("signature", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items")), "leak-signatures")
    hits = met(hits.drop("classes"), listed, ["signature"], "uid", small)
    full = texts.select("uid", F.col("id").alias(id_col), "n_words").join(hits, "uid", "left")
    zero = F.lit(0).cast("long")
    return full.select(
        id_col, "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )
