import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from surgeline.llm import sentencepiece_bpe as S
from surgeline.llm.queries import piece_model, token_digests


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_words_as_the_library(library):
    rng = random.Random(2)
    alphabets = ["aab ▁\n\t", "the and on er in  ", "日本語 é", "\u0000🎉👩‍👩 a<s><unk>", "▁▁  　x"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(n)) for n in [0, 1, 2, 3, 9, 40, 200] * 40]
    texts += [" " * n for n in (1, 2, 3, 17, 33, 100, 3000)] + ["a" * 5000, "ab" * 3000, "x" + " " * 2500 + "y"]
    encoder, decoder = S.Encoder(piece_model()), S.Decoder(piece_model())
    for text, ids, want in zip(texts, encoder.encode(texts), library.encode(texts)):
        assert ids.tolist() == want
        assert decoder.decode(np.array(want, np.int32)) == library.decode(want)


def test_windows_and_small_memo(library, monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 50)
    monkeypatch.setattr(S, "MEMO", 5)
    text = "the cat sat on the mat " * 40 + "é" * 300 + " end"
    assert S.Encoder(piece_model()).encode([text, "", text])[2].tolist() == library.encode(text)


@pytest.mark.parametrize("ending", ["x", " ", "  ", "x ", " x", "é", "\n ", "▁", "the end "])
def test_texts_about_as_long_as_a_window(library, monkeypatch, ending):
    monkeypatch.setattr(S, "WINDOW", 50)
    for n in (48, 49, 50, 51, 52, 99, 100, 101):
        for start in ("the cat sat on the mat and ran ", "abcdefgh", "a b "):
            text = (start * 40)[: n - len(ending)] + ending
            assert len(text) == n and S.Encoder(piece_model()).encode([text])[0].tolist() == library.encode(text)


def test_any_ids_decode_as_the_library(library):
    rng = random.Random(3)
    decoder = S.Decoder(piece_model())
    for _ in range(300):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(1, 12))]
        assert decoder.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_frame(docs, none, clashing, library):
    def digest(df):
        coded = S.decode(S.encode(df, piece_model(), out="ids"), piece_model())
        return coded.select("doc_id", "text", *[c.alias(n) for n, c in token_digests(coded).items()]).collect()

    for rows in (digest(docs), digest(clashing)):
        assert len(rows) == 32
        for r in rows:
            ids = library.encode(r.text or "")
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert digest(none) == []


def test_one_pass_equals_two(docs, clashing, none):
    for df in (docs, clashing):
        two = S.decode(S.encode(df, piece_model()), piece_model()).select("doc_id", "ids", "decoded").collect()
        assert sorted(two, key=str) == sorted(S.recode(df, piece_model()).select("doc_id", "ids", "decoded").collect(), key=str)
    assert S.recode(none, piece_model()).collect() == []
