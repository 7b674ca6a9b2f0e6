"""Mixing sources to target weights by capped water-filling.

Each source has a weight and may be taken ``max_epochs`` times at most. All sources share the total
by weight; where a share is above the most a source can give, it is clamped there and the excess goes
to the others by weight, until no share is too large. The fill level is found by repeated aggregates
over the table of sources, so only a few numbers reach the driver, however many sources there are.

A source's target is then met by whole repetitions of all its documents and one fractional repetition
of the documents that come first in a seeded order; the document at its end counts with part of its
words, so a source misses its target by less than one word. The order is by a hash of the id, then the
size, then a hash of the whole row. Where the repetition ends is found by aggregates over ever finer groups
of that order, so neither a source that holds most rows nor many rows with one id or none meet in a task.

Null sizes count as 0; a null source is a source of its own, last in the order; repeated rows are
rows like others. A source without words has target 0. Reruns give the same result. Empty tables give
an empty result; further columns pass through.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from surgeline.llm.common import free_name
from surgeline.session import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20260
BROADCAST_ROWS = 100_000  # a table of at most so many sources is broadcast
BROADCAST_LETTERS = 16 << 20  # and of at most so many characters of their names
SALTS = 64


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes, partitions=64):
    """Sources with their place in code point order, null last, from 0."""
    cut = sizes.repartitionByRange(partitions, F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    mask = (1 << 33) - 1
    cut = written(cut.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(mask)).alias("at")), "mix-sources")
    before, offset = 0, {}
    for r in cut.groupBy("part").count().orderBy("part").collect():  # a number per partition
        offset[r["part"]] = before
        before += r["count"]
    if not offset:
        return cut.select("source", "source_size", F.lit(0).cast("long").alias("place"))
    start = F.create_map(*[F.lit(x) for kv in offset.items() for x in kv])
    return cut.select("source", "source_size", (F.col("at") + start[F.col("part")]).alias("place"))


def fill_level(sources, total):
    """The share of one unit of weight once every clamped source has given its excess away.

    ``sources``: weight and most, the largest possible target.
    """
    level = 0.0
    while True:
        clamped = F.col("weight") * F.lit(level) > F.col("most")
        free, given = sources.agg(
            F.sum(F.when(~clamped, F.col("weight"))).alias("free"), F.sum(F.when(clamped, F.col("most"))).alias("given")
        ).first()
        if not free:
            return level
        new = (total - (given or 0.0)) / free
        if new <= level:
            return level
        level = new


def source_targets(sized, weights=WEIGHTS, max_epochs=MAX_EPOCHS):
    """Per source: source_size, target, copies (whole repetitions), rest (words of the fractional one)."""
    sizes = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    placed = ranked_sources(sizes)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = written(
        placed.select("source", "source_size", cycle[(F.col("place") % len(weights)).cast("int")].alias("weight"), (F.col("source_size") * F.lit(float(max_epochs))).alias("most")),
        "mix-weights",
    )
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = fill_level(table, total)
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    out = table.select("source", "source_size", F.round(target, 6).alias("target"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return out.withColumn("copies", copies).withColumn(
        "rest", F.floor(F.col("target") - F.col("copies") * F.col("source_size") + 0.5).cast("long")
    )


def _beside(rows, table, salt, on=()):
    """``rows`` with the columns of ``table``, which has one row per source, named ``of`` there.

    ``on`` pairs further columns that must be equal. A table counted as small is broadcast; a larger one is
    dealt over salts taken from the hash ``salt``, as one source may hold most rows.
    """
    match = F.col("source").eqNullSafe(F.col("of"))
    for mine, its in on:
        match = match & (F.col(mine) == F.col(its))
    n, letters = table.agg(F.count(F.lit(1)), F.sum(F.length(F.col("of").cast("string")))).first()
    if n <= BROADCAST_ROWS and (letters or 0) <= BROADCAST_LETTERS:
        return rows.join(F.broadcast(table), match)
    dealt = table.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(dealt, match & (F.pmod(F.col(salt), F.lit(SALTS)) == F.col("_mix_salt"))).drop("_mix_salt")


def _cut(rows, cuts, names):
    """``cuts`` narrowed to the group, by ``names``, of each source in which its rest runs out.

    Groups of a source are in the order of ``names``; ``rest`` becomes what is left at the group, ``n`` its rows.
    """
    sums = rows.groupBy("source", *names).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("source").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    inside = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words"))
    hit = sums.join(cuts.drop("n"), F.col("source").eqNullSafe(F.col("of"))).filter(inside)
    kept = [c for c in cuts.columns if c not in ("rest", "n")]
    return written(hit.select(*kept, *[F.col(c).alias(f"at_{c}") for c in names], (F.col("rest") - F.col("before")).alias("rest"), F.col("rows").alias("n")), "mix-cut")


def cuts(rows, targets):
    """Per source with a fractional repetition: the row at which it ends, by key, size and mark.

    Found level by level, each an aggregate of only the rows that the level before left open: first bins of the
    key, then the key, then size and bins of the mark, then the mark. So many rows under one key, as those
    without an id have it, are added up before they are shuffled. ``n`` rows can be equal in all this.
    """
    found = targets.filter(F.col("rest") > 0).select(F.col("source").alias("of"), "rest")
    rows = rows.withColumns({"bin": F.substring("key", 1, 3), "high": F.shiftright("mark", 52)})
    for names in (("bin",), ("key",), ("size", "high"), ("mark",)):
        found = _cut(rows, found, names)
        rows = _beside(rows, found.select("of", *[f"at_{c}" for c in names]), "mark", [(c, f"at_{c}") for c in names]).select(*rows.columns)
    return found.select("of", "at_key", "at_size", "at_mark", "rest", "n")


def mix(df, id_col="doc_id", source="source", size="size", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED):
    """``df`` with source_size, target, copies, part_words and taken = copies * size + part_words.

    ``copies`` counts whole repetitions of the row, ``part_words`` the words of a further, fractional
    one: the whole size, nothing, or for one row per source something between. Rows are never sorted or
    dealt anew for that: each is compared to the row at which its source's fractional repetition ends.
    """
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    own = df.toDF(*names.values())
    hashed = [F.col(f.name) for f in own.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    rows = own.withColumns({
        "source": F.col(names[source]),
        "size": F.coalesce(F.col(names[size]), F.lit(0)).cast("long"),
        "key": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(names[id_col]).cast("string"), F.lit("")))),
        "mark": F.xxhash64(*hashed),  # tells rows with one id, or none, apart
    })
    keys = written(rows.select("source", "size", "key", "mark"), "mix-keys")  # sizes are found once
    targets = written(source_targets(keys, weights, max_epochs), "mix-targets")
    ends = cuts(keys, targets)
    plan = targets.select(F.col("source").alias("to"), "source_size", "target", "copies").join(ends, F.col("to").eqNullSafe(F.col("of")), "left")
    plan = written(plan.drop("of").withColumnRenamed("to", "of"), "mix-plan")
    met = _beside(rows, plan, "mark")
    here, end = F.struct("key", "size", "mark"), F.struct(F.col("at_key"), F.col("at_size"), F.col("at_mark"))
    ended = F.col("at_key").isNotNull()
    tie = ended & (here == end) & (F.col("n") > 1)
    part = F.when(ended & (here < end), F.col("size")).when(ended & (here == end), F.col("rest")).otherwise(0).cast("long")
    if plan.filter(F.col("n") > 1).isEmpty():
        done = met.withColumn("part", part)
    else:
        done = met.filter(~F.coalesce(tie, F.lit(False))).withColumn("part", part).unionByName(_dealt(met.filter(tie)))
    left = [F.col(n).alias(c) for c, n in names.items() if c not in ("source_size", "target", "copies", "part_words", "taken")]
    return done.select(
        *left, "source_size", "target", "copies", F.col("part").alias("part_words"), (F.col("copies") * F.col("size") + F.col("part")).alias("taken")
    )


def _dealt(equal):
    """Part of each of the rows that are equal in all columns and in which the rest runs out.

    Any order of them gives the same rows, so they are numbered as they are stored, partition by partition.
    """
    stored = written(equal.withColumns({"piece": F.spark_partition_id(), "line": F.monotonically_increasing_id()}), "mix-equal")
    counts = stored.groupBy("of", "piece").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("of").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(F.col("of").alias("its"), F.col("piece").alias("block"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"))
    numbered = stored.withColumn("place", F.row_number().over(Window.partitionBy("of", "piece").orderBy("line")) - 1)
    numbered = numbered.join(ahead, F.col("of").eqNullSafe(F.col("its")) & (F.col("piece") == F.col("block")))
    left = F.col("rest") - (F.col("before") + F.col("place")) * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")
    return numbered.withColumn("part", part).drop("piece", "line", "place", "its", "block", "before")


def repeated(df, mixed, size="size"):
    """The rows of ``mixed`` as often as the mix takes them, with the columns of ``df``.

    Texts stay whole: a fractional repetition becomes a further copy if at least half of it is taken.
    """
    extra = ((F.col("part_words") > 0) & (2 * F.col("part_words") >= F.col(size))).cast("long")
    times = F.col("copies") + extra
    turn = free_name(mixed, "turn")
    rows = mixed.withColumn(turn, F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1))))).filter(times > 0)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])


def remixed(df, size, id_col="doc_id", source="source", **options):
    """The rows of ``df`` as often as the mix takes them; ``size`` is a Column, and any further column stays as it is."""
    names = [f"c{i}" for i in range(len(df.columns))]
    own = dict(zip(df.columns, names))
    sized = df.withColumn(free_name(df, "words"), size).toDF(*names, "words")
    mixed = mix(sized, id_col=own[id_col], source=own[source], size="words", **options)
    return repeated(sized, mixed, size="words").select(*names).toDF(*df.columns)
