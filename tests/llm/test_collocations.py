"""Phrase collocations against brute force, and on awkward input."""

import collections
import random
import re

import pyarrow as pa
import pytest

from sigscore.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, rank long, n int"


def brute(rows, least, top):
    f, sizes = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            sizes[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * a >= 80 * f[lang, w[i:i + m]]:
                    gone.add((lang, w[i:i + m]))
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]],
                                  f[lang, w[k:]]) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, sizes[lang], -s) for lang, v in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])}


def found(spark, rows, least, top=2000):
    df = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (t, lang) in enumerate(rows)], SCHEMA)
    return {tuple(r) for r in C.collocations(df, least, top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def rows(seed, n):
    rng = random.Random(seed)
    words = ["Of", "the", "a", "é", "zwölf", "b\x00c", "x" * 40, "new", "york", "city"]
    def text():
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append("New York city hall" if rng.random() < 0.2 else rng.choice(words))
            out.append(rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r\n", "\x0b"]))
        return "".join(out)
    return [(text(), rng.choice(["en", "en", "de", None, "und", ""])) for _ in range(n)]


def test_equals_brute_force_when_tries_spill(spark, monkeypatch):
    """Small tries, few known words and short counts: phrases go over every boundary."""
    for name, value in (("TOKENS", 50), ("ENTRIES", 40), ("KNOWN", 12)):
        monkeypatch.setattr(C, name, value)
    r = rows(1, 120)
    assert found(spark, r, 4) == brute(r, 4, 2000)


def test_awkward(spark):
    r = [(None, "en"), ("", "en"), (" \t\n", None), ("one", "en"), ("a b " * 40, None), ("a b " * 40, None),
         ("Hot Pair. " * 5000, "en"), ("w " * 70_000, "de"), ("é É " * 30, "fr"), ("x,y;" * 50, "fr")]
    assert found(spark, r, 30) == brute(r, 30, 2000)
    assert found(spark, r, 30, 2) == brute(r, 30, 2)


def test_empty(spark):
    assert found(spark, [], 2) == set()
    assert found(spark, [("a b c", "en")], 2) == set()


def test_containers_burst(monkeypatch):
    monkeypatch.setattr(C, "BURST", 3)
    rng = random.Random(5)
    trie, want = C.HatTrie(), collections.Counter()
    for _ in range(400):
        p, n = tuple(rng.randint(1, 4) for _ in range(rng.choice((3, 4)))), rng.randint(1, 3)
        trie.add(p[0], [p[1:]], [n])
        want[p] += n
    assert trie.entries == len(want) and any(node for node, _ in trie.root.values())
    got = collections.Counter()
    for share in (0.5, 1.0):
        ids, counts = C.HatTrie.phrases(trie.take(share))
        for n, phrases in ids.items():
            for p, c in zip(phrases.tolist(), counts[n]):
                got[tuple(p)] += c
    assert got == want and trie.entries == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(C, "SLICE", 7)
    text = b"one two  three\tfour, five" * 9 + b"z" * 50
    parts = list(C._slices(text))
    assert b"".join(parts) == text and len(parts) > 9
    assert [w for p in parts for w in C.tokens(p)] == C.tokens(text)


def test_repeated_words_are_looked_up_once(monkeypatch):
    """Counting costs a look-up for each distinct word of the texts held, not one for each word."""
    asked = []

    class Ids(C._Ids):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    class Texts:
        def mapInArrow(self, work, schema):
            return work

    monkeypatch.setattr(C, "_Ids", Ids)
    work = C.count_runs(Texts(), (2,), 4)
    out = list(work([pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(["New york, new york "] * 50)],
                                                names=["lang", "text"])]))
    assert sorted(asked) == [b".", b"new", b"york"]
    got = collections.Counter()
    for batch in out:
        for run, counts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            got.update(dict(C._unpacked(run, counts)))
    assert got == {b"new york": 100}
