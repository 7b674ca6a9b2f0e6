import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A few documents with nulls, empty and long texts, copies, near copies and repeated rows."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(80)]
    near = list(base)
    near[40] = "zzz"
    rows = [
        (1, " ".join(base), "en", "a", 1), (2, "  ".join(base) + "\n", "en", "a", 2), (3, " ".join(near), "en", "b", 3),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \t\n", "en", None, 3), (7, "123 !!", "en", "b", 5),
        (8, " ".join(word() for _ in range(9000)), "en", "c", 9), (9, "one two", None, "c", 7), (9, "one two", None, "c", 7),
        (None, "one two", "en", "c", 7), (10, "日本語 é ▁ x", "ja", "d", 9),
    ]
    rows += [(20 + i, " ".join(word() for _ in range(60)), "en", "a", 60) for i in range(20)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(docs):
    """The documents with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "uid", "key", "keys", "n", "size", "shard", "slot", "words", "block", "name", "node", "k0", "rank", "bin", "class", "kept", "score", "ids",
             "_row_sha", "_row_points", "_row_mark", "keep_id", "_keep_id", "row_sha", "target", "copies", "part_words", "taken", "_mix_times", "source_size"]
    return docs.withColumns({n: F.lit("x") for n in names})
