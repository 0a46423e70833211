"""Exact substring dedup against brute force, and on awkward input."""

import collections
import hashlib
import random

import pytest

from conftest import SF_SMALL
from sigscore.llm import suffix_dedup as S
from sigscore.llm._common import table

SCHEMA = "doc_id long, text string, key long, digest string, copies int"


def brute(rows, length):
    bodies = [(text or "").encode() for _, text in rows]
    n = collections.Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, bodies):
        gone = bytearray(len(b) + 2)
        for i in range(len(b) - length + 1):
            if n[b[i:i + length]] > 1:
                gone[i + 1:i + length + 1] = b"\x01" * length
        spans = sum(1 for i in range(1, len(gone)) if gone[i] and not gone[i - 1])
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, length):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return sorted(map(tuple, S.repeated_bytes(df, length).drop("spans").collect()), key=str)


def rows(seed, n, passages=12):
    """Passages of several lengths between own words; copies, near copies, one that a third holds."""
    rng = random.Random(seed)
    letters = "abcdeé ß漢"
    own = lambda m: "".join(rng.choices(letters, k=m))
    shared = [own(rng.randint(5, 90)) for _ in range(passages)]
    out = []
    for i in range(n):
        if rng.random() < 0.33:
            text = shared[0] * 2 + own(rng.randint(0, 3)) + shared[1]
        else:
            text = "".join(rng.choice(shared) if rng.random() < 0.4 else own(rng.randint(0, 40))
                           for _ in range(rng.randint(0, 8)))
        out.append((rng.choice([i, i, i, 7, None]), text))
    return out + rng.sample(out, n // 8)


@pytest.mark.parametrize("length", [1, 2, 3, 5, 10, 20, 61, 400])
def test_cover_meets_every_difference(length):
    period, cover = S.difference_cover(length)
    assert period <= max(1, S.COVER_SHARE * length)
    assert {(i - j) % period for i in cover for j in cover} == set(range(period))
    if length == 400:
        assert (period, len(cover)) == (307, 18)


@pytest.mark.parametrize("length, seed", [(20, 1), (61, 2)])
def test_equals_brute_force(spark, monkeypatch, length, seed):
    """Small packs, chunks and several buckets of suffixes."""
    for name, value in (("HELD_PER_TASK", 300), ("CHUNK", 37), ("BUCKET_SHARE", 0.05)):
        monkeypatch.setattr(S, name, value)
    r = rows(seed, 150)
    assert found(spark, r, length) == brute(r, length)


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    r = [(x["doc_id"], x["text"]) for x in docs.collect()]
    got = sorted(map(tuple, S.op12(spark, SF_SMALL).collect()), key=str)
    assert got == brute(r, S.LENGTH)


def test_awkward(spark):
    x = "".join(random.Random(9).choices("abcdefgh ", k=3000))
    r = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, "a" * 1500), (5, "ab" * 500), (None, x[:1000]),
         (None, x[500:1500]), (6, x[1000:2000] + "é" * 300), (7, "漢" * 200), (8, "é" * 400 + x[1500:1899]),
         (9, x[2000:2900]), (9, x[2000:2900]), (10, "b" * 400), (11, "c" * 401)]
    assert found(spark, r, 400) == brute(r, 400)


def test_empty(spark):
    assert found(spark, [], 400) == []


def test_spans_are_the_removed_bytes(spark):
    text = "x" * 5 + "0123456789abcdefghij" + "y" * 3
    df = spark.createDataFrame([(1, text, 0, "", 0), (2, "0123456789abcdefghij", 0, "", 0)], SCHEMA)
    import numpy as np
    got = {r["doc_id"]: r for r in S.repeated_bytes(df, 20).collect()}
    assert np.frombuffer(got[1]["spans"], np.int64).tolist() == [5, 25]
    assert got[2]["n_removed"] == 20 and got[1]["n_spans"] == got[2]["n_spans"] == 1
