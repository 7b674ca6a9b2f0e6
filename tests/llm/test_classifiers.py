import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeline.llm import language_id, quality, queries, toxicity


def test_suffix_automaton_knows_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(20):
        s = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        moves = language_id.Moves(language_id.suffix_automaton(s), 3)
        subs = {tuple(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for _ in range(100):
            t = [rng.randrange(3) for _ in range(rng.randint(1, 6))]
            state = 0
            for c in t:
                state = int(moves.next(np.array([state]), np.array([c]))[0][0]) if state >= 0 else -1
            assert (state >= 0) == (tuple(t) in subs)


def test_phrases_as_by_hand():
    model = language_id.Model({"aa": ["the cat sat"], "bb": ["der hund lief"]})
    for text in ("the cat ran", "der hund", "x y z thehund", "q"):
        symbols, _ = model.alphabet.read([text])
        for k, sample in enumerate(("the cat sat", "der hund lief")):
            known, n, i = model.alphabet.read([sample])[0].tolist(), 0, 0
            s = symbols.tolist()
            has = lambda part: any(known[a : a + len(part)] == part for a in range(len(known)))
            while i < len(s):
                j = i
                while j < len(s) and has(s[i : j + 1]):
                    j += 1
                i, n = max(j, i + 1), n + 1
            lanes = symbols.astype(np.int32)[:, None]
            got = int(model.phrases(lanes, model.moves[k])[0])
            assert got == n


def brute_phrases(known, s):
    """Longest matches from left to right, on plain lists."""
    n = i = 0
    has = lambda part: any(known[a : a + len(part)] == part for a in range(len(known)))
    while i < len(s):
        j = i
        while j < len(s) and has(s[i : j + 1]):
            j += 1
        i, n = max(j, i + 1), n + 1
    return n


@pytest.mark.parametrize("lane, block", [(4, 2), (8, 3), (16, 16), (7, 50)])
def test_phrases_run_across_lanes(monkeypatch, lane, block):
    monkeypatch.setattr(language_id, "LANE", lane)
    monkeypatch.setattr(language_id, "BLOCK", block)
    rng = random.Random(lane)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    samples = {"aa": [text(30, "abc ")], "bb": [text(40, "abd "), "dddddddddddddddddddddddd"], "cc": ["abcabcabcabcabcabcabcabc"]}
    model = language_id.Model(samples)
    texts = [text(rng.randint(0, 70), "abcdx ") for _ in range(60)] + ["", "abc" * 30, "d" * 90, "1", "x" * 33]
    names, scores = model.predict(texts)
    for t, name, score in zip(texts, names, scores):
        s = model.alphabet.read([t])[0].tolist()
        if not any(c.isalpha() for c in t):
            assert (name, score) == ("und", 0.0)
            continue
        bits = []
        for lang in sorted(samples):
            known = model.alphabet.read([" ".join(samples[lang])])[0].tolist()
            bits.append(brute_phrases(known, s) * math.log2(max(2, len(known))) / len(s))
        assert name == sorted(samples)[int(np.argmin(bits))]
        least, second = sorted(bits)[:2]
        assert math.isclose(score, second / (least + second))


def test_language_learns_from_whole_texts(spark):
    """What tells the languages apart stands far behind the beginning of the texts."""
    rng = random.Random(2)
    words = lambda pool: " ".join(rng.choice(pool) for _ in range(1500))
    one, two, both = ["house", "river", "walks"], ["maison", "fleuve", "marche"], "lorem ipsum dolor sit amet " * 60
    rows = [(i, both + words(one if i % 2 else two), "one" if i % 2 else "two") for i in range(40)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.predict(["the river walks a house", "la maison du fleuve marche"])[0] == ["one", "two"]


def test_language_wide_scripts_and_many_languages(spark, monkeypatch):
    rng = random.Random(4)
    wide = lambda at: "".join(chr(at + rng.randrange(2500)) for _ in range(4000))
    zh, ko = wide(0x4E00), wide(0xAC00)
    model = language_id.Model({"zh": [zh], "ko": [ko]})
    assert all(len(m.slot) <= 1 << 17 for m in model.moves)  # by the sample, not by the letters
    assert model.predict([zh[100:140], ko[100:140]])[0] == ["zh", "ko"]
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    many = spark.createDataFrame([(i, f"text number {i}", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="4 languages"):
        language_id.fit(many)


def test_language_odd_rows(spark, docs, none, clashing):
    train = spark.createDataFrame([(i, "the and of to in it is that " * 5, "en") for i in range(9)] + [(50 + i, "der und die das ist nicht ein " * 5, "de") for i in range(9)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    new = spark.createDataFrame([(1, "that is in it"), (2, "das ist nicht"), (3, None), (4, ""), (5, "12 !"), (6, "THE AND OF"), (7, "der und " * 30000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(new, model).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en", 7: "de"}
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language_id.fit(none) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    out = language_id.predict(clashing, model)
    assert out.count() == 32 and dict(out.dtypes)["score"] == "double"
    assert language_id.predict(none, model).collect() == []


def test_quality_and_toxicity_learn(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["house", "river", "walks", "green", "under", "light", "paper", "seven"])
    rows = []
    for i in range(300):
        good, toxic = i % 2, int(i % 5 == 0)
        text = [word() if good else word()[::-1] + "###" for _ in range(rng.randint(20, 60))]
        if toxic:
            text.insert(rng.randrange(len(text)), "vermin")
        rows.append((i, " ".join(text), good, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    train, test = df.filter("doc_id % 3 > 0"), df.filter("doc_id % 3 = 0")
    for fitted, scored, label in ((quality.fit, quality.score, "quality"), (toxicity.fit, toxicity.score, "toxic")):
        got = scored(test.drop("quality", "toxic"), fitted(train)).join(df.select("doc_id", label), "doc_id").collect()
        right = sum((r.score >= 0.3) == bool(r[label]) for r in got)
        assert right >= 0.95 * len(got)


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_with_odd_rows(spark, docs, none, clashing, module, label):
    train = docs.withColumn(label, F.when(F.col("doc_id") < 25, 1).when(F.col("doc_id") < 40, 0))
    model = module.fit(train)
    for df in (docs, clashing):
        rows = module.score(df, model).collect()
        assert len(rows) == 32 and all(0 <= r.score <= 1 for r in rows)
    assert module.score(none, model).collect() == []
    for nothing in (none.withColumn(label, F.lit(None).cast("int")), docs.withColumn(label, F.lit(1))):
        rows = module.score(docs, module.fit(nothing)).collect()
        assert len(rows) == 32 and all(0 <= r.score <= 1 for r in rows)


def test_registered_classifiers_leave_the_held_out_rows_alone(spark, sf):
    for name, folds, fold in (("op4_quality", 5, 0), ("op6_language", 5, 0), ("op8_toxicity", 4, 2)):
        import zlib

        rows = queries.QUERIES[name](spark, sf).select("doc_id", "held_out").collect()
        assert len(rows) == 200
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)


def test_quality_is_fitted_on_whole_texts(spark):
    """What tells the labels apart stands behind 5,000 characters that say nothing."""
    rng = random.Random(4)
    words = ["house", "river", "walks", "green", "under", "light", "paper", "seven"]
    rows = []
    for i in range(400):
        good = i % 2
        opening = " ".join(rng.choice(["amber", "crane", "delta", "ember"]) for _ in range(900))
        tail = " ".join(rng.choice(words) if good else rng.choice(words)[::-1] + "###" for _ in range(1500))
        rows.append((i, opening + " " + tail, good))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    train, test = df.filter("doc_id % 3 > 0"), df.filter("doc_id % 3 = 0")
    got = quality.score(test, quality.fit(train)).collect()
    assert sum((r.score >= 0.3) == bool(r.quality) for r in got) >= 0.95 * len(got)


def test_toxicity_is_learned_alike_for_any_number_of_partitions(spark, monkeypatch):
    """Several shards, each learned by itself, against the plain per-coordinate steps."""
    monkeypatch.setattr(toxicity, "SHARD", 40)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["nice", "day", "out", "here"] + ["vermin"] * (i % 3 == 0)) for _ in range(12)), int(i % 3 == 0)) for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    before, models = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("4", "211"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            models.append(toxicity.fit(df.repartition(int(n) // 4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert models[0].index.tolist() == models[1].index.tolist()
    assert max(abs(a - b) for a, b in zip(models[0].weight.tolist(), models[1].weight.tolist())) < 1e-6

    draws = {r.doc_id: r.d for r in df.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)).alias("d")).collect()}
    total = {}
    for shard in range(4):
        own = sorted((draws[i], y, toxicity.distinct_features([t])[0]) for i, t, y in rows if draws[i] % 4 == shard)
        z, n = {}, {}

        def weight(i):
            shrunk = abs(z.get(i, 0.0)) - (0.0 if i == 1 << toxicity.BITS else toxicity.L1)
            return -(1 if z[i] > 0 else -1) * shrunk / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2) if shrunk > 0 and i in z else 0.0

        for turn in range(toxicity.PASSES):
            for _, y, x in own if turn % 2 == 0 else own[::-1]:
                at = [*x.tolist(), 1 << toxicity.BITS]
                w = {i: weight(i) for i in at}
                g = 1 / (1 + math.exp(-sum(w.values()))) - y
                for i in at:
                    old = n.get(i, 0.0)
                    z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / toxicity.ALPHA * w[i]
                    n[i] = old + g * g
        for i in z:
            total[i] = total.get(i, 0.0) + weight(i) * len(own) / 160
    constant = total.pop(1 << toxicity.BITS)
    want = {i: w for i, w in total.items() if w}
    assert set(models[0].index.tolist()) == set(want) and abs(models[0].constant - constant) < 1e-9
    assert all(abs(w - want[i]) < 1e-6 for i, w in zip(models[0].index.tolist(), models[0].weight.tolist()))
