"""Sharding by histogram sort.

Rows are ordered by a 126-bit key: a hash of the text, then a hash of the id, so equal texts stand
side by side. The bytes and rows below candidate boundaries are counted exactly, in histograms of the
whole table; a bin that holds a wanted splitter with more bytes than the tolerance, or more rows than
a task should sort, is probed again with finer boundaries between its least and largest key, first
along the text hash and, when a bin holds a single text, along the id hash. Only these histograms reach the
driver. When every splitter is met, the rows are exchanged once, by bin.

The law is ``bytes``: every shard gets the same bytes up to the tolerance (or the one row that stands
at a boundary). A group of equal texts stays in one shard unless the boundary falls inside it by more
than the tolerance, as it must for a group larger than a shard. Shards are filled in key order; a slot
is the row's place in its shard, gapless from 0. Null texts have no bytes besides the overhead; rows
equal in text and id share a key and are interchangeable; an empty table gives an empty result.
"""

from bisect import bisect_right

from pyspark.sql import Window
from pyspark.sql import functions as F

from surgeline.llm.common import free_name
from surgeline.session import written

OVERHEAD = 16
TOLERANCE = 0.002  # of a shard
FAN = 4096  # first bins
FINER = 256  # bins of a bin probed again
SHARE = 1024  # no bin to sort holds more than this part of the rows
TOP = (1 << 63) - 1


def key_columns(id_col, text):
    """Two non-negative halves of the key."""
    salt = F.lit("shard")
    half = lambda *c: F.xxhash64(*c).bitwiseAND(F.lit(TOP))
    return half(F.coalesce(F.col(text), F.lit("")), salt), half(F.col(id_col).cast("string"), salt)


def size_of(text):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


class _Bin:
    """A range of keys: along text hashes (half 0) or, within one text hash, along id hashes (half 1)."""

    def __init__(self, node, number, half, lo, hi, fixed, rows, size):
        self.node, self.number, self.half, self.lo, self.hi, self.fixed = node, number, half, lo, hi, fixed
        self.rows, self.size = rows, size


def _shift(lo, hi, bins):
    """Bits to drop so that ``lo``..``hi`` falls into at most ``bins`` bins."""
    return max(0, (hi - lo).bit_length() - (bins.bit_length() - 1))


def _histogram(keys, nodes, first):
    """Rows, bytes and key range of every bin; ``nodes``: (node, parent, number, half, lo, shift)."""
    out = _binned(keys, nodes, first)
    if nodes:
        out = out.filter(F.col("node") >= min(n[0] for n in nodes[-1]))
    return out.groupBy("node", "number").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("size"),
        F.min("k0").alias("lo0"), F.max("k0").alias("hi0"), F.min("k1").alias("lo1"), F.max("k1").alias("hi1"),
    ).collect()


def _binned(keys, rounds, first):
    """``keys`` with the node and number of the finest bin of each row."""
    out = keys.withColumns({"node": F.lit(0), "number": F.shiftright("k0", first).cast("int")})
    spark = keys.sparkSession
    for nodes in rounds:  # a table of the bins probed again: at most a few thousand rows
        finer = spark.createDataFrame(nodes, "child int, node int, number int, half int, lo long, shift int")
        out = out.join(F.broadcast(finer), ["node", "number"], "left")
        at = F.expr("cast(shiftright(if(half = 0, k0, k1) - lo, shift) as int)")
        deeper = F.col("child").isNotNull()
        out = out.withColumns({"number": F.when(deeper, at).otherwise(F.col("number")), "node": F.coalesce("child", "node")})
        out = out.drop("child", "half", "lo", "shift")
    return out


def plan(keys, shards, tolerance=TOLERANCE):
    """The bins in key order and the row ranks at which the shards begin.

    ``keys``: k0, k1, size. Returns (first shift, rounds of nodes, bins, starts).
    """
    first = 63 - (FAN.bit_length() - 1)
    rounds, n_nodes, fixed_rank = [], 1, []
    bins = [_Bin(r["node"], r["number"], 0, r["lo0"], r["hi0"], (r["lo1"], r["hi1"]), r["rows"], r["size"]) for r in _histogram(keys, [], first)]
    bins.sort(key=lambda b: b.lo)
    total_rows, total = sum(b.rows for b in bins), sum(b.size for b in bins)
    slack = tolerance * total / shards / 2
    wanted = [total * i / shards for i in range(1, shards)]
    while True:
        below, again = 0, []
        ends = []
        for b in bins:
            below += b.size
            ends.append(below)
        for i, b in enumerate(bins):
            a, e = ends[i] - b.size, ends[i]
            held = any(a + slack < w < e - slack for w in wanted[bisect_right(wanted, a) : bisect_right(wanted, e)])
            one_key = b.lo == b.hi and (b.half == 1 or b.fixed[0] == b.fixed[1])
            if not one_key and b.rows > 1 and (held or b.rows > max(1, total_rows / SHARE)):
                again.append(b)
        if not again:
            break
        nodes, parents = [], {}
        for b in again:
            half, lo, hi = (1, *b.fixed) if b.half == 0 and b.lo == b.hi else (b.half, b.lo, b.hi)
            nodes.append((n_nodes, b.node, b.number, half, lo, _shift(lo, hi, FINER)))
            parents[n_nodes] = (b, half)
            n_nodes += 1
        rounds.append(nodes)
        finer = {}
        for r in _histogram(keys, rounds, first):
            half = parents[r["node"]][1]
            x = _Bin(r["node"], r["number"], half, r[f"lo{half}"], r[f"hi{half}"], (r["lo1"], r["hi1"]), r["rows"], r["size"])
            finer.setdefault((parents[r["node"]][0].node, parents[r["node"]][0].number), []).append(x)
        bins = [y for b in bins for y in (sorted(finer[(b.node, b.number)], key=lambda x: x.lo) if (b.node, b.number) in finer else [b])]
    starts, below, rank, i = [0], 0, 0, 0
    for w in wanted:
        while i < len(bins) and below + bins[i].size <= w:
            below, rank, i = below + bins[i].size, rank + bins[i].rows, i + 1
        extra = 0
        if i < len(bins):
            b = bins[i]
            if b.rows > 1 and b.lo == b.hi and (b.half == 1 or b.fixed[0] == b.fixed[1]):
                extra = round((w - below) * b.rows / b.size)  # equal rows: any of them
            elif w - below > b.size / 2:
                extra = b.rows
        starts.append(max(starts[-1], rank + extra))
    return first, rounds, bins, starts


def shard(df, shards, id_col="doc_id", text="text", tolerance=TOLERANCE):
    """``df`` with size, shard and slot."""
    k0, k1 = key_columns(id_col, text)
    # a key takes 24 bytes of the row; texts are read for this once
    keys = written(df.select(k0.alias("k0"), k1.alias("k1"), size_of(text).alias("size")), "shard-keys")
    first, rounds, bins, starts = plan(keys, shards, tolerance)
    own = [c for c in df.columns if c not in ("size", "shard", "slot")]
    names = {c: free_name(df, f"shard_{c}") for c in own}
    carried = df.select(*[F.col(f"`{c}`").alias(names[c]) for c in own], k0.alias("k0"), k1.alias("k1"), size_of(text).alias("size"))
    rank, table = 0, []
    for b in bins:
        table.append((b.node, b.number, rank))
        rank += b.rows
    spark = df.sparkSession
    # one row per bin: at most FAN + FINER * (SHARE + shards) for a round of probes
    base = spark.createDataFrame(table, "node int, number int, base long")
    placed = _binned(carried, rounds, first).join(F.broadcast(base), ["node", "number"])
    w = Window.partitionBy("node", "number").orderBy("k0", "k1")
    placed = placed.withColumn("rank", F.col("base") + F.row_number().over(w) - 1)
    edges = F.array(*[F.lit(s).cast("long") for s in starts])
    number = F.size(F.filter(edges, lambda s: s <= F.col("rank"))) - 1
    placed = placed.withColumn("shard", number.cast("int"))
    return placed.select(
        *[F.col(names[c]).alias(c) for c in own], "size", "shard", (F.col("rank") - edges[F.col("shard")]).alias("slot"),
    )
