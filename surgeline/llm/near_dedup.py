"""Near duplicates by order min-hashing.

The k-mers of a text are its runs of five words, each labelled with its occurrence number. For each of
``SKETCHES`` hash functions the ``TAKEN`` smallest labelled k-mers are taken and put in text order; texts
that agree in one such sketch are candidates. Unlike a set of minima, a sketch also sees the order, as
edit similarity does. Candidates are verified by a banded alignment of their labelled k-mers: with M
aligned pairs, similarity is M / (n1 + n2 - M), and 0.8 or more makes a link. Classes are the connected
components of the links; of each class the row with the smallest id stays.

Copies (equal in words) are folded first, so a group of copies costs one row per copy and no pairs.
Within a bucket of candidates not all pairs are formed: in each round some pivots are compared with
the members of other components; a pivot is done when it has met all others, a bucket when its
members are one component. Every pair of a bucket is thus either compared or connected by verified links,
and no link between components is lost. Pivots are the texts that share most sketches with others, as the
original of a group of near copies does, so the first round connects most buckets; later rounds take four times as many.

Before two texts are paired, their parity bits are compared: each k-mer turns one of at least as many bits as the text has
k-mers. Two texts differ in at least as many k-mers as bits, so a pair with too many of them cannot be a link;
this drops no link, but nearly all pairs of texts that share much and yet are not alike.

Words are runs of letters, marks and digits in lower case. Texts of fewer than five words have one
k-mer, all their words; null, empty and other texts without a word are alone in their class. Long
texts are read whole; repeated rows fall into one class. An empty table gives an empty result;
further columns, whatever their names, are not touched.
"""

from bisect import bisect_left

import numpy as np
import pyarrow as pa

from pyspark.sql import Window
from pyspark.sql import functions as F

from surgeline.llm.common import free_name, sliced, texts_of
from surgeline.llm.textcodes import _P, mixed, shingles, words
from surgeline.session import written

K = 5
SIMILARITY = 0.8
SKETCHES = 18
TAKEN = 4
ROWS = 512
_ODD = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def occurrences(value, doc):
    """For each k-mer the number of equal ones before it in its text."""
    order = np.argsort(value * np.uint64(31) + mixed(doc.astype(np.uint64)), kind="stable")
    v, d = value[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    start = np.flatnonzero(new)
    out = np.empty(len(v), np.int64)
    out[order] = np.arange(len(v)) - start[np.cumsum(new) - 1] if len(v) else 0
    return out


def labelled(value, doc, k=K):
    """Labelled k-mers of texts given as words (hash, text), and the text of each, in text order."""
    kmer, owner, at = shingles(value, doc, k)
    n_docs = int(doc[-1]) + 1 if len(doc) else 0
    count = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):  # all the words of a short text are its one k-mer
        begin = np.searchsorted(doc, short)
        whole = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            more = count[short] > i
            whole[more] = whole[more] * _P + value[begin[more] + i]
        kmer = np.concatenate([kmer, mixed(whole + np.uint64(1))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        kmer, owner = kmer[order], owner[order]
    number = occurrences(kmer, owner).astype(np.uint64)
    return np.where(number > 0, mixed(kmer + number * np.uint64(0xD6E8FEB86659FD93)), kmer), owner


def sketches(kmer, owner, n_docs, count=SKETCHES, taken=TAKEN):
    """(n_docs, count) sketch hashes; a text needs a k-mer to have one."""
    out = np.zeros((n_docs, count), np.uint64)
    if not len(kmer):
        return out
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    size = np.diff(start, append=len(kmer))
    docs = owner[start]
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s in range(count):
        h = (kmer ^ _ODD[128 + s]) * _ODD[s]
        h ^= h >> np.uint64(29)
        places = np.full((taken, len(docs)), len(kmer), np.int64)
        for t in range(taken):
            best = np.minimum.reduceat(h, start)
            hit = np.flatnonzero(h == np.repeat(best, size))
            seg = np.searchsorted(start, hit, side="right") - 1
            first = np.flatnonzero(np.diff(seg, prepend=-1))
            real = h[hit[first]] != top
            places[t, seg[first[real]]] = hit[first[real]]
            h[hit[first]] = top
        places.sort(axis=0)
        total = np.full(len(docs), np.uint64(s + 1))
        padded = np.append(kmer, np.uint64(0))
        for t in range(taken):
            total = mixed(total * _P + padded[places[t]])
        out[docs, s] = total
    return out


def parities(kmer, owner, n_docs):
    """Bits of every text as 64-bit words, all in one array, and how many words each text has: a power of two.

    A bit tells whether an odd number of k-mers falls on it. The words of a text folded in half are those it would have with half
    as many bits.
    """
    size = np.maximum(np.bincount(owner, minlength=n_docs), 1)
    held = 1 << np.ceil(np.log2(-(-size // 64))).astype(np.int64)
    start = np.cumsum(held) - held
    bit = (kmer & (held[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(start[owner] * 64 + bit, minlength=int(held.sum()) * 64) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64), held


def _differing(a, b):
    """Bits that differ between two texts, given as ``parities`` of the same or of neighbouring sizes."""
    def folded(x):
        half = F.size(x) / 2
        return F.zip_with(F.slice(x, F.lit(1), half.cast("int")), F.slice(x, (half + 1).cast("int"), half.cast("int")), lambda u, v: u.bitwiseXOR(v))

    def count(x, y):
        return F.aggregate(F.zip_with(x, y, lambda u, v: u.bitwiseXOR(v)), F.lit(0), lambda total, x: total + F.bit_count(x))

    return F.when(F.size(a) == F.size(b), count(a, b)).when(F.size(a) > F.size(b), count(folded(a), b)).otherwise(count(a, folded(b)))


def similarity(a, b):
    """Banded alignment of two lists of labelled k-mers, each k-mer at most once in a list.

    Common k-mers are matched pairs; the longest chain that rises in both texts is the alignment. With the
    wanted similarity no aligned pair can be further from the diagonal than the k-mers left unaligned,
    which is the band. Below the wanted similarity the result is an upper bound.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    total = len(a) + len(b)
    jaccard = len(i) / (total - len(i)) if total > len(i) else 0.0
    if jaccard < SIMILARITY:
        return jaccard  # aligned it is no more
    order = np.argsort(i)
    i, j = i[order], j[order]
    band = int((1 - SIMILARITY) / (1 + SIMILARITY) * total) + 1
    j = j[np.abs(i - j) <= band]
    aligned = len(j)
    if aligned > 1 and (np.diff(j) < 0).any():
        ends = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            if at == len(ends):
                ends.append(x)
            else:
                ends[at] = x
        aligned = len(ends)
    return aligned / (total - aligned)


def _profile(batches):
    """Content key, k-mer count, sketches, parity bits and 16-bit words of every text."""
    for batch in sliced(batches, ROWS):
        n = batch.num_rows
        value, doc, _, _ = words(texts_of(batch, "text"))
        kmer, owner = labelled(value, doc)
        bounds = np.searchsorted(doc, np.arange(n + 1))
        size = np.diff(bounds)
        place = np.arange(len(value)) - np.repeat(bounds[:-1], size)
        content = np.zeros((2, n), np.uint64)
        if len(value):
            some = size > 0
            for c in (0, 1):
                power = np.multiply.accumulate(np.full(int(size.max()), _ODD[64 + c]))
                content[c, some] = mixed(np.add.reduceat(value * power[place], bounds[:-1][some]))
        keys = sketches(kmer, owner, n)
        counts = np.bincount(owner, minlength=n)
        flat = pa.array(keys.ravel().view(np.int64))
        offsets = np.arange(n + 1, dtype=np.int32) * keys.shape[1]
        bits, held = parities(kmer, owner, n)
        spans = np.concatenate([[0], np.cumsum(held)]).astype(np.int32)
        half = (value & np.uint64(0xFFFF)).astype(np.uint16)
        cut = [half[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c) for c in ("id", "mark", "points")], pa.array(counts.astype(np.int64)),
                pa.array(content[0].view(np.int64)), pa.array(content[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), flat), pa.ListArray.from_arrays(pa.array(spans), pa.array(bits.view(np.int64))),
                pa.array(cut, pa.binary()),
            ],
            names=["id", "mark", "points", "n", "c0", "c1", "keys", "bits", "words"],
        )


def _kmers(data):
    value = np.frombuffer(data, np.uint16).astype(np.uint64) + np.uint64(1)
    return labelled(mixed(value), np.zeros(len(value), np.int64))[0]


def _verify(batches):
    """The pairs (a, b) with their words: linked or not."""
    last, kmers = None, None
    for batch in sliced(batches, 256):
        found = []
        for a, wa, wb in zip(*[batch.column(c).to_pylist() for c in ("a", "words_a", "words_b")]):
            if a != last:
                last, kmers = a, _kmers(wa)
            found.append(similarity(kmers, _kmers(wb)) >= SIMILARITY)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.bool_())], names=["a", "b", "linked"])


def components(links):
    """(node, comp) of every node of ``links`` (a, b): comp is the smallest node connected to it.

    Labels go to neighbours and then jump to the label's own label, so that even long chains take few
    rounds.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "near-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "near-labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("comp")), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = written(labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")), "near-step")
        over = step.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = step.join(over, "comp", "left").select("node", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp"))
        new = written(new, "near-labels")
        labels = new.select("node", "comp")
        if new.filter("old != comp").isEmpty():
            return labels


def extended(labels, links):
    """``labels`` (node, comp) after further ``links``; only the graph of components is searched again."""
    if labels is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
        ends = ends.join(known, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    between = written(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).filter("a != b"), "near-merges")
    if between.isEmpty():
        return labels
    merged = components(between)
    new = merged.select("node").join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))
    moved = labels.unionByName(new).join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    return written(moved.select("node", F.coalesce("to", "comp").alias("comp")), "near-labels")


def classes(members, content):
    """(node, comp) of all reps that are linked to another one; None if no bucket holds two.

    ``members``: key, rep, n; ``content``: uid, bits, words of every rep.
    """
    held = written(members.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1"), "near-held")
    active = written(members.join(held, "key"), "near-active")
    central = active.groupBy("rep").agg(F.sum("held").alias("central"))
    active = written(active.join(central, "rep").select("key", "rep", "n", "central", F.col("rep").alias("comp")), "near-active")
    reps = written(active.select(F.col("rep").alias("uid")).distinct(), "near-reps")  # written, so that few of them are broadcast and no text is shuffled
    known = written(content.join(reps, "uid"), "near-words")
    known_words, known_bits = known.select("uid", "words"), known.select(F.col("uid").alias("rep"), "bits")
    tested, labels, pivots = None, None, 1
    while not active.isEmpty():
        w = Window.partitionBy("key").orderBy(F.desc("central"), "rep")
        chosen = active.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= pivots)
        chosen = written(chosen.select("key", F.col("rep").alias("p"), F.col("n").alias("np"), F.col("comp").alias("cp")), "near-pivots")
        few = (1 - SIMILARITY) / (1 + SIMILARITY) * (F.col("n") + F.col("np")) + 1e-6  # k-mers by which a link's texts differ at most
        near = (F.col("comp") != F.col("cp")) & (F.least("n", "np") >= SIMILARITY * F.greatest("n", "np")) & (_differing(F.col("bits"), F.col("bits_p")) <= few)
        pivot_bits = known_bits.select(F.col("rep").alias("p"), F.col("bits").alias("bits_p"))
        met = active.join(known_bits, "rep").join(chosen.join(pivot_bits, "p"), "key").filter(near)
        pairs = met.select(F.least("p", "rep").alias("a"), F.greatest("p", "rep").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-pairs")
        needed = pairs.select(F.col("a").alias("uid")).unionByName(pairs.select(F.col("b").alias("uid"))).distinct()
        needed = written(known_words.join(written(needed, "near-needed"), "uid"), "near-needed-words")
        with_a = pairs.join(needed.select(F.col("uid").alias("a"), F.col("words").alias("words_a")), "a")
        with_b = with_a.join(needed.select(F.col("uid").alias("b"), F.col("words").alias("words_b")), "b")
        new = written(with_b.select("a", "b", "words_a", "words_b").mapInArrow(_verify, "a long, b long, linked boolean"), "near-tested")
        tested = new if tested is None else tested.unionByName(new)
        labels = extended(labels, new.filter("linked").select("a", "b"))
        rest = active.drop("comp").join(chosen.select("key", F.col("p").alias("rep")), ["key", "rep"], "left_anti")
        rest = rest.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        rest = written(rest, "near-rest")
        open_keys = rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("key")
        active = written(rest.join(open_keys, "key"), "near-active")
        pivots *= 4
    return labels


def near_classes(df, id_col="doc_id", text="text"):
    """One row per row of ``df``: id, class_id (smallest id of the class), class_size, kept, mark, points.

    ``mark`` (hash of the text) and ``points`` (its length) find the row again.
    """
    source = df.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("points"), F.col(text).alias("text")
    )
    id_type = source.schema["id"].dataType.simpleString()
    profile = source.mapInArrow(_profile, f"id {id_type}, mark long, points long, n long, c0 long, c1 long, keys array<long>, bits array<long>, words binary")
    rows = written(profile.withColumn("uid", F.monotonically_increasing_id()), "near-rows")
    texts = written(
        rows.filter("n > 0").groupBy("n", "c0", "c1").agg(F.min("uid").alias("rep"), F.first("keys").alias("keys")), "near-texts"
    )
    members = written(texts.select("rep", "n", F.explode("keys").alias("key")), "near-members")
    labels = classes(members, rows.select("uid", "bits", "words"))
    content = texts.select("n", "c0", "c1", "rep")
    placed = rows.drop("keys", "bits", "words").join(content, ["n", "c0", "c1"], "left")
    placed = placed.withColumn("rep", F.coalesce("rep", "uid"))
    if labels is not None:
        placed = placed.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class", F.coalesce("comp", "rep")).drop("comp")
    else:
        placed = placed.withColumn("class", F.col("rep"))
    placed = written(placed.select("uid", "id", "mark", "points", "class"), "near-placed")
    best = F.struct(F.col("id").isNull().alias("o"), F.col("id").alias("id"), "uid")
    groups = written(placed.groupBy("class").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("class_size")), "near-classes")
    return placed.join(groups, "class").select(
        F.col("id").alias(id_col), F.col("best.id").alias("class_id"), "class_size", (F.col("uid") == F.col("best.uid")).alias("kept"), "mark", "points"
    )


def near_deduplicated(df, id_col="doc_id", text="text"):
    """One row of each class, with all columns of ``df``."""
    k_id, k_points, k_mark, points, mark = (free_name(df, n) for n in ("keep_id", "keep_points", "keep_mark", "row_points", "row_mark"))
    kept = near_classes(df, id_col, text).filter("kept").select(F.col(id_col).alias(k_id), F.col("mark").alias(k_mark), F.col("points").alias(k_points))
    rows = df.withColumns({mark: F.xxhash64(text), points: F.coalesce(F.length(text), F.lit(0)).cast("long")})
    same = F.col(id_col).eqNullSafe(F.col(k_id)) & (F.col(mark) == F.col(k_mark)) & (F.col(points) == F.col(k_points))
    out = rows.join(kept, same, "left_semi").dropDuplicates([id_col, mark, points])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
