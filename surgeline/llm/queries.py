"""One query for each operator: production parameters, whole tables, full results."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from surgeline.llm import (
    alignment, ann, decontamination, exact_dedup, language_id, mixing, near_dedup, quality, sentencepiece_bpe, sharding, substring_dedup, toxicity, zone_maps,
)
from surgeline.llm.common import held_out
from surgeline.session import written

QUERIES = {}
ORACLES = {}


def query(oracle=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def piece_model():
    """Path of the public SentencePiece model; another one may be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model():
    """Path of the public byte-level BPE model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests(df, ids="ids", decoded="decoded"):
    """n_tokens and the digests of the ids and the decoded text."""
    joined = F.concat_ws(",", F.col(ids).cast(T.ArrayType(T.StringType())))
    return {
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(joined, 256),
        "decoded_sha256": F.sha2(F.col(decoded), 256),
    }


@query()
def op1_sentencepiece(spark, folder):
    """Every whole text encoded and decoded again, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, piece_model()).drop("text"), piece_model())
    return coded.select("doc_id", *[c.alias(n) for n, c in token_digests(coded).items()])


SHARDS = 40


@query()
def op2_sharding(spark, folder):
    """All documents in 40 shards of near equal bytes."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.coalesce(F.crc32("text"), F.lit(0)).cast("long"))
    return sharding.shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(oracle=r"""WITH d AS (SELECT doc_id, COALESCE(text, '') AS text, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
 r AS (SELECT doc_id, sha256(norm) AS sha, length(text) AS n, norm FROM d),
 g AS (SELECT *, FIRST_VALUE(doc_id) OVER w AS keep_id, ROW_NUMBER() OVER w AS rn, COUNT(*) OVER (PARTITION BY norm) AS group_size
 FROM r WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST))
 SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha AS text_sha256 FROM g""")
def op7_exact_dedup(spark, folder):
    """Groups of documents with equal texts, white space aside, and the row that stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(oracle=r"""WITH d AS (SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
 md5('20260:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
 s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 w AS (SELECT source, source_size, CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
 o AS (SELECT *, 3.0 * source_size / weight AS cap,
 COALESCE(SUM(3.0 * source_size) OVER f, 0.0) AS given, COALESCE(SUM(weight) OVER f, 0.0) AS used FROM w
 WINDOW f AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 l AS (SELECT MAX(level) AS level FROM (SELECT ((SELECT SUM(source_size) FROM s) - given) / ((SELECT SUM(weight) FROM w) - used) AS level, cap FROM o) AS q),
 t AS (SELECT source, source_size, ROUND(LEAST(weight * level, 3.0 * source_size), 6) AS target FROM w, l),
 p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(FLOOR(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
 q AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.copies, CAST(FLOOR(p.target - p.copies * p.source_size + 0.5) AS BIGINT) AS rest,
 COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
 FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
 SELECT doc_id, size, source_size, target, CAST(copies * size + GREATEST(0, LEAST(size, rest - before)) AS BIGINT) AS taken FROM q""")
def op9_mixing(spark, folder):
    """Words that the target mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    sized = written(docs, "mix-documents")  # texts are read once
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


def _judged(spark, folder, label, folds, fold):
    """Documents with text and held_out, and the labelled rows to learn from."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", held_out("doc_id", folds, fold))
    labels = table(spark, folder, "labels").select("doc_id", label)
    return docs, docs.filter(~F.col("held_out")).join(labels, "doc_id")


def _verdict(scored):
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op4_quality(spark, folder):
    """Quality of every whole text, learned from labels outside the held-out fifth."""
    docs, labelled = _judged(spark, folder, "quality", 5, 0)
    return _verdict(quality.score(docs, quality.fit(labelled)).drop("text"))


@query()
def op6_language(spark, folder):
    """Language of every whole text, learned from documents outside the held-out fifth."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out("doc_id", 5, 0))
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op8_toxicity(spark, folder):
    """Toxicity of every whole text, learned from labels outside the held-out fourth."""
    docs, labelled = _judged(spark, folder, "toxic", 4, 2)
    return _verdict(toxicity.score(docs, toxicity.fit(labelled)).drop("text"))


@query()
def op5_ann(spark, folder):
    """The five nearest found for every fiftieth vector."""
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query()
def op10_near_dedup(spark, folder):
    """Class of near duplicates of every document, and the row that stays."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_dedup.near_classes(docs).select("doc_id", "class_id", "class_size", "kept")


@query()
def op3_substring_dedup(spark, folder):
    """Fuzzy passages of 50 words and more that stand in several documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.passages(docs)


_WORDS = r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(oracle=f"""WITH d AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rn, doc_id, {_WORDS} AS w FROM documents),
 b AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
 bi AS (SELECT item, w, LEAST(10, len(w)) AS m, UNNEST(range(1, len(w) - LEAST(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
 bw AS MATERIALIZED (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM bi),
 l AS (SELECT DISTINCT m FROM bw),
 di AS (SELECT rn, w, m, UNNEST(range(1, len(w) - m + 2)) AS i FROM d, l WHERE len(w) >= m),
 h AS MATERIALIZED (SELECT rn, i, m, item FROM (SELECT rn, i, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM di) AS x JOIN bw USING (m, win)),
 p AS (SELECT rn, COUNT(DISTINCT j) AS n_hit FROM (SELECT rn, UNNEST(range(i, i + m)) AS j FROM (SELECT DISTINCT rn, i, m FROM h) AS y) AS z GROUP BY rn),
 t AS (SELECT rn, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rn, item FROM h) AS u GROUP BY rn)
 SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(COALESCE(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(t.n_items, 0) AS BIGINT) AS n_items,
 sha256(COALESCE(t.items, '')) AS items_sha256, COALESCE(p.n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p USING (rn) LEFT JOIN t USING (rn)""")
def op11_decontamination(spark, folder):
    """Words of every document inside ten words or more of a benchmark item, and those items."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated")


@query()
def op12_alignment(spark, folder):
    """Groups and links of the tokens of two tokenizers over every whole text."""
    return alignment.align(table(spark, folder, "documents"), byte_model(), piece_model())


CLUSTERS, ROUNDS, COMPONENTS, CLUSTER_SEED = 40, 5, 64, 2


def _cluster_sql():
    """The rounds written out, one pair of views each."""
    views = [f"""v AS MATERIALIZED (SELECT ROW_NUMBER() OVER () AS rn, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT ROW_NUMBER() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('{CLUSTER_SEED}:' || COALESCE(CAST(vec_id AS VARCHAR), '')) AS h, v
 FROM v ORDER BY h, v LIMIT {CLUSTERS}) AS s)"""]
    dot = "list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
    far = f"CAST({dot.format(a='v.v', b='v.v')} - 2 * {dot.format(a='v.v', b='k.v')} + {dot.format(a='k.v', b='k.v')} AS BIGINT)"
    for r in range(ROUNDS + 1):
        views.append(f"""a{r} AS MATERIALIZED (SELECT rn, vec_id, v, c, d FROM (SELECT rn, vec_id, v, c, d, ROW_NUMBER() OVER (PARTITION BY rn ORDER BY d, c) AS o
 FROM (SELECT v.rn, v.vec_id, v.v, k.c, {far} AS d FROM v, c{r} k) AS x) AS y WHERE o = 1)""")
        if r < ROUNDS:
            views.append(f"""c{r + 1} AS MATERIALIZED (SELECT k.c, COALESCE(n.v, k.v) AS v FROM c{r} k LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
 SELECT c, i, SUM(x) AS s, COUNT(*) AS n FROM (SELECT c, UNNEST(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) AS e GROUP BY c, i) AS g GROUP BY c) n ON n.c = k.c)""")
    body = f"""SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(SUM(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(SUM(a.d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(k.v, ',')) AS centroid_sha256 FROM a{ROUNDS} a JOIN c{ROUNDS} k ON k.c = a.c"""
    return "WITH " + ",\n".join(views) + "\n" + body


@query(oracle=_cluster_sql())
def op13_centroids(spark, folder):
    """Cluster, distance and inertia of every vector after five exact rounds."""
    found = zone_maps.cluster(table(spark, folder, "embeddings"), CLUSTERS, ROUNDS, COMPONENTS, CLUSTER_SEED)
    return found.withColumns({c: F.col(c).cast("long") for c in ("cluster_inertia", "inertia")})
