import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeline.llm import decontamination as D


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    grams = {}
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + m]), set()).add(str(item) if item is not None else "")
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(g) for g in grams}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in grams:
                    hit.update(range(i, i + m))
                    found |= grams[tuple(w[i : i + m])]
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)))
    return out


def check(spark, docs, items, **more):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id string, text string")
    got = [tuple(r) for r in D.contamination(left, right, **more).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items), key=str)
    return got


def test_equals_every_window(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("a b c d e f g h i j k l m n o p".split())
    items = [(f"i{k}", " ".join(word() for _ in range(rng.randint(0, 40)))) for k in range(30)]
    docs = []
    for d in range(60):
        parts = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a, n = rng.randint(0, max(0, len(w) - 1)), rng.randint(5, 20)
            at = rng.randint(0, len(parts))
            parts[at:at] = w[a : a + n]
        docs.append((d, rng.choice([" ", "  ", "-", ". "]).join(parts).upper() if d % 3 else " ".join(parts)))
    got = check(spark, docs, items)
    assert 5 < sum(r[5] for r in got) < 60


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10, 11, 15])
def test_spans_of_any_length(spark, n):
    w = [f"w{i}" for i in range(n)]
    docs = [(1, " ".join(["x"] + w + ["y"])), (2, " ".join(w[1:])), (3, " ".join(w[:-1])), (4, " ".join(w + w)), (5, " ".join(w[: n // 2] + ["z"] + w[n // 2 :]))]
    got = {r[0]: r for r in check(spark, docs, [("a", " ".join(w)), ("b", "unrelated")])}
    assert got[1][2] == n and got[4][2] == 2 * n


def test_odd_rows(spark, docs, none):
    items = [("1", None), ("2", ""), (None, "one two"), ("4", "One, TWO!"), ("4", "three four"), ("5", "日本語"), ("6", "É"), ("7", "\x00 ...")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = check(spark, rows, items)
    assert sorted(r[4] for r in got if r[5]) == [",4", ",4", ",4", "5"]
    table = spark.createDataFrame(items, "item_id string, text string")
    assert D.contamination(none, table).collect() == []
    clean = D.contamination(docs, table.limit(0)).collect()
    assert len(clean) == len(rows) and not any(r.contaminated for r in clean)


def test_further_columns_are_left_alone(spark, clashing, docs):
    items = spark.createDataFrame([("4", "One, TWO!", "x")], "item_id string, text string, item string")
    plain, other = (D.contamination(df, items).collect() for df in (docs, clashing))
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, other), key=str)


@pytest.mark.parametrize("small", [0, 100_000])
def test_a_passage_in_many_texts_and_items(spark, small):
    """Both ways of joining: with a broadcast table and with salts."""
    common = " ".join(f"c{i}" for i in range(40))
    docs = [(i, f"{common} own{i}") for i in range(300)] + [(1000, "clean")]
    check(spark, docs, [(f"i{i}", f"start{i} {common}") for i in range(50)] + [("last", "own7 c0")], small=small)


def test_every_long_span_keeps_a_fingerprint():
    """A window keeps the same run in any text, and windows of equal content are equal."""
    rng = np.random.default_rng(2)
    value = D.mixed(rng.integers(0, 50, 400).astype(np.uint64))
    mark, content, at = D.windows(value, np.zeros(400, int))
    own, whole, place = D.windows(value[100:130], np.zeros(30, int))
    assert (mark[100:121] == own).all() and (content[100:121] == whole).all() and len(at) == 391 and len(place) == 21
    assert len(np.unique(mark)) < 0.5 * len(mark)
