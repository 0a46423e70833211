"""Whole words, letters by category and the learning sample of language identification, against
sums in exact fractions."""

from fractions import Fraction
import math
import random

import numpy as np

from sigscore.llm import language_id as L

PIECES = {b" ": (.01, .02), b"a": (.1, 1e-7), b"b": (.05, .2), b"ab": (.3, .1), b" a": (.2, .05),
          b"bab": (1e-7, .3), b"abab": (.1, 1e-7)}


def exact(word, language):
    """Log of the sum over all segmentations, without rounding."""
    b = b" " + word.encode()
    ahead = [Fraction(1)]
    for end in range(1, len(b) + 1):
        ahead.append(sum(ahead[s] * Fraction(PIECES[b[s:end]][language])
                         for s in range(max(0, end - 4), end) if b[s:end] in PIECES))
    return math.log(ahead[-1].numerator) - math.log(ahead[-1].denominator)


def test_words_of_any_length_equal_exact_sums(monkeypatch):
    monkeypatch.setattr(L, "WORDS_AT_ONCE", 7)
    pick = random.Random(3)
    words = ["".join(pick.choice("ab") for _ in range(n))
             for n in (1, 2, 5, 30, 38, 39, 40, 41, 42, 80, 80, 200, 700, 3, 41)]
    model = L.Unigrams(["x", "y"], PIECES)
    got = model.words(words)
    assert 30 < model.short < 60
    for w, logs in zip(words, got):
        assert np.allclose(logs, [exact(w, 0), exact(w, 1)], rtol=1e-10)
    one = model.words(["ab" * 10_000])
    assert np.isfinite(one).all() and (one < -5_000).all()


def test_expected_pieces_of_a_long_word():
    logs = {p: math.log(x[0]) for p, x in PIECES.items()}
    word = "ab" * 400 + "b" * 50
    used = L.expected_pieces(b" " + word.encode(), logs, 4)
    assert math.isclose(sum(len(p) * n for p, n in used.items()), len(word) + 1, rel_tol=1e-9)
    # one use more of a piece is what the log of the sum gains by that piece's log probability
    step = 1e-5
    L2 = {**PIECES, b"ab": (PIECES[b"ab"][0] * math.exp(step), .1)}
    gain = (L.Unigrams(["x", "y"], L2).word(word) - L.Unigrams(["x", "y"], PIECES).word(word))[0]
    assert math.isclose(gain / step, used[b"ab"], rel_tol=1e-3)


def test_letters_and_marks():
    assert L.words_of("½ ² ① Ⅷ 12 _ ́ …") == []
    assert L.words_of("नमस्ते Ünï-x2y") == ["नमस्ते", "ünï", "x", "y"]


def test_sample_ranks_distinct_ids(spark):
    rows = [(i % 3_000 if i < 6_000 else 5, "en" if i % 7 else "de", "x") for i in range(9_000)]
    rows += [(None, "en", "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {}
    for r in L._sample_ids(docs, 50).collect():
        got.setdefault(r["l"], set()).add(r["doc_id"])
    assert {x: len(i) for x, i in got.items()} == {"en": 50, "de": 50}
    small = L._sample_ids(docs.limit(40), 50).collect()
    assert len(small) == len(set(small)) == len(
        docs.limit(40).where("pmod(crc32(cast(doc_id as string)), 4) != 2").collect())


def test_awkward_rows(spark):
    rows = [(1, "½ ²", "en"), (None, "the old house", "en"), (2, "the old house", "en"),
            (2, "the old house", "en"), (3, "das alte haus", "de"), (4, "z" * 5_000, None),
            (5, "", "de"), (6, None, "de")]
    docs = spark.createDataFrame([(*r, 1) for r in rows],
                                 "doc_id long, text string, lang string, score int")
    got = L.language_id(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(tuple(r)[2:])
    assert all(by[i] == [("und", 0.0)] for i in (1, 5, 6)) and by[2][0] == by[2][1] == by[None][0]
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]
