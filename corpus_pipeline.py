"""From raw documents to a deduplicated, mixed and tokenised corpus.

Five stages in a row, each a Spark job over all that its predecessor kept: documents without a
recognisable language go, then exact copies, then near copies; what is left is repeated or thinned to
the target mix of sources; last, every text is tokenised. Each stage's result is written to the shared
folder as Parquet and read again, so a lost executor repeats no earlier stage.
"""

from pyspark.sql import functions as F

from surgeline.llm import exact_dedup, language_id, mixing, near_dedup, sentencepiece_bpe
from surgeline.llm.common import free_name, held_out
from surgeline.llm.queries import piece_model, token_digests
from surgeline.session import written


def language(spark, docs, sf_dir):
    """Documents whose language is recognised; those without text or without a letter go.

    Learned from the documents outside the held-out fifth. With nothing to learn from, every text with a letter stays.
    """
    model = language_id.fit(docs.filter(~held_out("doc_id", 5, 0)))
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    return language_id.predict(docs, model, out=found, score=score).filter(F.col(found) != language_id.UNKNOWN).select(*docs.columns)


def exact(spark, docs, sf_dir):
    """One document of each group of equal texts, white space aside."""
    return exact_dedup.deduplicated(docs)


def near(spark, docs, sf_dir):
    """One document of each class of near copies: five words, similarity 0.8."""
    return near_dedup.near_deduplicated(docs)


def mix(spark, docs, sf_dir):
    """Documents as often as the target mix of sources takes them."""
    return mixing.remixed(docs, mixing.word_count("text"))


def tokens(spark, docs, sf_dir):
    """Every row encoded and decoded: doc_id, source, n_tokens, ids_sha256, decoded_sha256."""
    rows = docs.select("doc_id", "source", "text")
    coded = sentencepiece_bpe.recode(rows, piece_model())
    return coded.select("doc_id", "source", *[c.alias(n) for n, c in token_digests(coded).items()])


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("tokens", tokens)]

# Suffix automata, sketches and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
