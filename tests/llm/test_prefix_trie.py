"""The conversation prefix trie against brute force, and on awkward input."""

import collections
import hashlib
import random
import zlib

import pytest

from sigscore.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, digest string, idx int"


def brute(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in full.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, cs in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(cs) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(full[c]) == len(k))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), kids[k], leaves[k],
                    saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, T.conversation_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def conversations(seed, n):
    """Some copies, shared beginnings, one very common conversation and turnless rebuilt ones."""
    rng = random.Random(seed)
    rows = []
    for c in [0, 100, 300, *rng.sample(range(1, 500), n)]:
        kind = rng.random()
        length = 9 if c % 100 == 0 else rng.randint(1, 8)
        for t in range(length):
            text = f"hot {t}" if kind < 0.35 else f"é{rng.randint(0, 1)} {t}" if kind < 0.7 else f"own {c} {t}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = conversations(seed, 60)
    assert found(spark, rows) == brute(rows)


def test_full_sketch_and_split_conversations_change_nothing(spark, monkeypatch):
    """A sketch that proves next to nothing, runs of three turns and chunks of two ids."""
    for name, value in (("SKETCH_LEAST", 8), ("SKETCH_MOST", 8), ("TURNS_PER_RUN", 3), ("IDS_PER_CHUNK", 2)):
        monkeypatch.setattr(T, name, value)
    rows = conversations(3, 40)
    assert found(spark, rows) == brute(rows)


def test_awkward(spark):
    rows = [(None, 1, "user", "nobody's"), (7, None, None, None), (7, None, None, None), (7, 1, "user", ""),
            (8, 1, "a", "b"), (8, 1, "a", "a"), (8, 1, "b", "a"), (9, 0, "ab", ""), (9, 1, "a", "b"),
            (11, 0, "x", "long " * 100_000), (12, 0, "x", "long " * 100_000), (-3, 0, "u", "neg")]
    rows += [(13, t, "u", f"t{t}") for t in range(70)]
    want = [r for r in brute([r for r in rows if r[0] is None or r[0] >= 0])]
    got = found(spark, [r for r in rows if r[0] is None or r[0] >= 0])
    assert got == want
    assert found(spark, rows)  # negative ids: c - c % 100 goes towards zero


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []


def test_one_sketch_bound_is_kept():
    assert T.SKETCH_ROWS * T.SKETCH_MOST * 2 // 8 <= 1 << 24
