import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgeline.llm import alignment as A
from surgeline.llm.queries import byte_model, piece_model


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(byte_model())
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=piece_model())


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(libraries, texts):
    """Tokens by the libraries, groups and links by comparing all spans of a text."""
    first, second = libraries
    shown = A.byte_symbols()
    docs = []
    for t in texts:
        a, b = (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)) if t else ([], [])
        pa = [bytes(shown[c] for c in first.id_to_token(i)) for i in a]
        pb = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not b"".join(pa) == b"".join(pb) == (" " + t).encode():
            docs.append(None)
            continue
        sa, sb = spans(pa), spans(pb)
        linked = [(a[i], b[j]) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if s < v and u < e]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [(",".join(str(x) for x, (_, e) in zip(a, sa) if c < e <= d), ",".join(str(x) for x, (_, e) in zip(b, sb) if c < e <= d)) for c, d in zip([0, *cuts], cuts)]
        docs.append((len(a), len(b), groups, linked))
    count = Counter(p for d in docs if d for p in set(d[3]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            digest = hashlib.sha256(";".join("|".join(g) for g in d[2]).encode()).hexdigest()
            out.append((d[0], d[1], len(d[2]), len(d[3]), sum(count[p] == most[p[0]] for p in d[3]), sum(count[p] for p in d[3]), digest))
    return out


ODD = [
    None, "", " ", "a", "▁", "a▁b", "<s> <|endoftext|> <unk> <0x41>", "日本語 é 😀", "\t\n  tab \r\n", "naïve café, don't I'll 12345", "x" * 1500, " " * 1200,
    "word " * 200, "\x00\x01", "   　", "ﬁ Å", "the the the",
]


@pytest.mark.parametrize("lookup", [0, 20, 1 << 20])
def test_equals_comparing_all_spans(spark, libraries, lookup):
    """Also with few pairs or none in the broadcast table, so that the others are joined."""
    texts = ODD + [f"sentence number {i} with shared wörds and {i * 7919}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in A.align(df, byte_model(), piece_model(), lookup=lookup).collect()}
    want = brute(libraries, texts)
    for i, t in enumerate(texts):
        assert got[i] == want[i], t
    assert got[5] == (0, 0, 0, 0, 0, 0, "") and got[9][0] > 0


def test_quick_and_slow_library_give_the_same_ids(libraries):
    encode, _ = A.byte_tokenizer(byte_model())
    texts = [" " + t for t in ODD if t] + [" " + "ab" * 700 + " c" * 30, " \n" * 900]
    assert encode(texts) == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("at", [0, 1, 499, 500, 777])
def test_every_long_run_is_looked_for(at):
    for c in ("a", " ", "\n", "\u3000", "é"):
        other = "b" if c.isspace() else " "
        assert A.may_run(other * at + c * A.RUN + other * 30)
        assert A.may_run((other + c) * at + c * (A.RUN + 1) + other)
    assert not A.may_run("some words and more " * 400) and not A.may_run("a" * (A.RUN - 1))


def test_digests_of_groups():
    ids_a, ids_b = np.array([7, 0, 12345, 10, 49999]), np.array([31, 5, 0, 9])
    label_a, label_b = np.array([0, 0, 1, 2, 2]), np.array([0, 1, 1, 2])
    found = A.digests(ids_a, ids_b, label_a, label_b, np.array([0, 0, 0, 2, 2]), np.array([0, 0, 0, 2]), 3)
    assert found == [hashlib.sha256(b"7,0|31;12345|5,0").hexdigest(), "", hashlib.sha256(b"10,49999|9").hexdigest()]


def test_long_text_and_repeated_rows(spark, libraries):
    texts = ["long text, " * 4000, "twice", "twice"]
    df = spark.createDataFrame([(1, texts[0]), (2, "twice"), (2, "twice")], "doc_id long, text string")
    got = sorted(tuple(r) for r in A.align(df, byte_model(), piece_model()).collect())
    assert [g[1:] for g in got][1:] == brute(libraries, texts[1:])
    assert got[0][1] > 5000 and len(got) == 3


def test_empty_table_and_further_columns(spark, docs, clashing, none):
    assert A.align(none, byte_model(), piece_model()).collect() == []
    plain, other = (A.align(df.withColumn("rest", F.lit(1)), byte_model(), piece_model()).collect() for df in (docs, clashing))
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, other), key=str)
    assert len(plain) == docs.count()
