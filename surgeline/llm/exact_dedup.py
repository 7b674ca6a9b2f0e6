"""Exact duplicates by deterministic block naming.

White space is deleted and each text is cut into fixed-size blocks. Equal blocks are brought together
by content, sorted and numbered: a block's number is its integer name. Then the names of adjacent
blocks form pairs, pairs are sorted and named the same way, and so on until each document has a
single name; two documents have the same identity exactly if their texts are equal. Names are numbers
of sorted contents, never hashes, so they cannot collide.

Block contents cross the network once. Rows find the name of their block by a 64-bit routing key;
that this key is one-to-one is verified on the contents, and it is drawn anew if it is not.

Nulls count as empty texts, which are all equal. Of equal texts the row with the most code points
stays, then the one with the smallest id (null ids last); of fully repeated rows one stays. Long texts only add
rounds: their number is the logarithm of the blocks of the longest text. Empty tables give an empty
result, and further columns, whatever their names, are not touched.
"""

from pyspark.sql import functions as F

from surgeline.llm.common import free_name
from surgeline.session import written

WHITE = r"[\x20\x09-\x0D]"
BLOCK = 4096  # code points


def normalised(text):
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), WHITE, "")


def xx_route(block, turn):
    return F.xxhash64(block, F.lit(turn))


def _blocks(text, size):
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(contents, keys):
    """Distinct contents sorted within their partition, with an integer that no other one has."""
    ordered = contents.distinct().sortWithinPartitions(*keys)
    return ordered.withColumn("name", F.monotonically_increasing_id())


def exact_dedup(df, id_col="doc_id", text="text", block=BLOCK, route=xx_route):
    """One row per row of ``df``: id, keep_id, group_size, kept, n_points, text_sha256.

    ``route(block, turn)`` is the routing key of a block in the given turn.
    """
    source = df.select(F.col(id_col).alias("id"), normalised(text).alias("norm"), F.length(text).alias("n_points"))
    turn = 0
    while True:
        cut = source.select("id", F.coalesce("n_points", F.lit(0)).alias("n_points"), F.sha2("norm", 256).alias("text_sha256"), _blocks(F.col("norm"), block).alias("blocks"))
        now = turn
        rows = written(
            cut.select(F.monotonically_increasing_id().alias("uid"), "id", "n_points", "text_sha256", F.transform("blocks", lambda b: route(b, now)).alias("keys")),
            "dedup-rows",
        )
        contents = source.select(F.explode(_blocks(F.col("norm"), block)).alias("block"))
        contents = contents.select(route(F.col("block"), turn).alias("key"), "block")
        names = written(_numbered(contents, ["key", "block"]).select("key", "name"), "dedup-names")
        if names.groupBy("key").count().filter("count > 1").isEmpty():
            break
        turn += 1
    places = rows.select("uid", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key"))
    named = written(places.join(names, "key").select("uid", "n", "pos", "name"), "dedup-level")
    done = [named.filter("n = 1").select("uid", F.lit(0).alias("level"), "name")]
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 1
    level = 0
    while longest > 1:
        level += 1
        half = F.floor(F.col("pos") / 2).cast("int").alias("pos")
        pairs = (
            named.filter("n > 1")
            .groupBy("uid", half, F.ceil(F.col("n") / 2).cast("int").alias("n"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"))
            .withColumn("b", F.coalesce("b", F.lit(-1)))  # a last block without a neighbour
        )
        names = written(_numbered(pairs.select("a", "b"), ["a", "b"]), "dedup-names")
        named = written(pairs.join(names, ["a", "b"]).select("uid", "n", "pos", "name"), "dedup-level")
        done.append(named.filter("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        longest = (longest + 1) // 2
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = written(rows.drop("keys").join(found, "uid"), "dedup-identities")
    best = F.struct((-F.col("n_points")).alias("p"), F.col("id").isNull().alias("o"), F.col("id").alias("id"), "uid")
    groups = written(found.groupBy("level", "name").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    return found.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"), "n_points", "text_sha256",
    )


def deduplicated(df, id_col="doc_id", text="text", block=BLOCK):
    """The rows of ``df`` that stay, with all their columns."""
    k_id, k_points, k_sha, points, sha = (free_name(df, n) for n in ("keep_id", "keep_points", "keep_sha", "row_points", "row_sha"))
    kept = exact_dedup(df, id_col, text, block).filter("kept").select(
        F.col(id_col).alias(k_id), F.col("n_points").alias(k_points), F.col("text_sha256").alias(k_sha)
    )
    rows = df.withColumns({sha: F.sha2(normalised(text), 256), points: F.coalesce(F.length(text), F.lit(0))})
    same = F.col(id_col).eqNullSafe(F.col(k_id)) & (F.col(sha) == F.col(k_sha)) & (F.col(points) == F.col(k_points))
    out = rows.join(kept, same, "left_semi").dropDuplicates([id_col, sha, points])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
