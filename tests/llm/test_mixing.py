"""Targets of the mix where ids are missing, shared or whole rows repeat, as brute force says."""

from collections import Counter
import random

import pytest

from sigscore.llm import mixing
from test_llm import brute_targets

SCHEMA = "doc_id long, text string, source string, size string, block string"


def documents(kind):
    """9,000 rows over three sources, a third of them with a hot id."""
    pick = random.Random(7)
    rows = []
    for i in range(9_000):
        n, source = pick.randint(1, 120), pick.choice(["a", "b", "b", None])
        hot = i % 3 == 0
        text = " ".join(f"w{pick.randrange(500)}" for _ in range(n))
        if hot and kind == "equal rows":
            text, source = "one and the same row of nine words here", "b"
        key = {"null ids": None, "one id": 77, "equal rows": 77, "equal null rows": None}[kind] if hot else i
        if hot and kind == "equal null rows":
            text, source = "one and the same row of nine words here", "a"
        rows.append((key, text, source, "clash", "clash"))
    return rows


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows", "equal null rows"])
def test_hot_ids_meet_the_targets(spark, kind):
    rows = documents(kind)
    docs = spark.createDataFrame(rows, SCHEMA)
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(text.split())
    want = brute_targets(dict(sizes))
    first = mixing._with_places(*mixing.plan_mix(docs)).collect()
    assert len(first) == len(rows)
    taken = Counter()
    for r in first:
        assert len(r["places"]) <= 2
        taken[r["source"]] += r["size"] * len(r["places"])
    assert all(abs(taken[s] - want[s]) <= 61 for s in want), (taken, want)
    again = mixing._with_places(*mixing.plan_mix(docs.repartition(7))).collect()
    alike = [Counter((r["doc_id"], r["digest"], r["source"], len(r["places"])) for r in x)
             for x in (first, again)]
    assert alike[0] == alike[1]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r["places"]) for r in first)
