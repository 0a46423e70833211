"""Compaction of walks to nonbranching paths, against a plain walk over the graph."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from sigscore.llm import de_bruijn
from sigscore.llm.substring_dedup import edge_hashes, node_hashes, pair_hashes

SCHEMA = "walk long, source long, nodes array<long>"


def brute_paths(walks):
    """Sets of edges of the maximal nonbranching paths, rings apart."""
    edges = {(a, b) for _, _, n in walks for a, b in zip(n, n[1:])}
    out, into = collections.defaultdict(set), collections.defaultdict(set)
    for a, b in edges:
        out[a].add(b)
        into[b].add(a)
    plain = {x for x in set(out) | set(into) if len(out[x]) == 1 and len(into[x]) == 1}
    paths, seen = [], set()
    for a, b in edges:
        if a in plain:
            continue
        path = [(a, b)]
        while path[-1][1] in plain:
            x = path[-1][1]
            path.append((x, next(iter(out[x]))))
        seen |= set(path)
        paths.append(frozenset(path))
    return edges, set(paths), edges - seen


def compacted(spark, walks):
    rows = de_bruijn.compact(spark.createDataFrame(walks, SCHEMA)).collect()
    paths = collections.defaultdict(dict)
    for r in rows:
        assert r["place"] not in paths[r["path"]]
        paths[r["path"]][r["place"]] = r["nodes"]
    out = []
    for pieces in paths.values():
        assert sorted(pieces) == list(range(len(pieces)))
        nodes = list(pieces[0])
        for i in range(1, len(pieces)):
            assert pieces[i][0] == nodes[-1]
            nodes += pieces[i][1:]
        out.append(list(zip(nodes, nodes[1:])))
    return rows, out


@pytest.mark.parametrize("seed", [1, 2])
def test_paths_are_the_nonbranching_ones(spark, seed):
    rng = random.Random(seed)
    texts = [[rng.randrange(400) for _ in range(60)] for _ in range(6)]
    walks = []
    for i in range(60):
        t = rng.choice(texts)
        lo = rng.randrange(50)
        walks.append((i, rng.randrange(20), t[lo:lo + rng.randrange(2, 60)]))
    walks = [w for w in walks if len(w[2]) > 1]
    edges, paths, ring = brute_paths(walks)
    rows, got = compacted(spark, walks)
    flat = [e for p in got for e in p]
    assert len(flat) == len(set(flat)) and set(flat) == edges
    assert {frozenset(p) for p in got if not set(p) & ring} == paths
    least = {}
    for _, s, n in walks:
        for e in zip(n, n[1:]):
            least[e] = min(least.get(e, s), s)
    for r in rows:
        assert r["source"] == min(least[e] for e in zip(r["nodes"], r["nodes"][1:]))


def test_chain_of_overlaps_is_one_path(spark):
    walks = [(i, i, list(range(3 * i, 3 * i + 7))) for i in range(40)]
    random.Random(3).shuffle(walks)
    _, got = compacted(spark, walks)
    assert len(got) == 1 and got[0] == [(x, x + 1) for x in range(3 * 39 + 6)]


def test_rings_repeats_and_no_walks(spark):
    ring = [(0, 5, [1, 2, 3, 1]), (1, 4, [2, 3, 1, 2]), (2, 4, [2, 3, 1, 2]), (3, 1, [9, 9, 9])]
    _, got = compacted(spark, ring)
    assert sorted(e for p in got for e in p) == [(1, 2), (2, 3), (3, 1), (9, 9)]
    assert de_bruijn.compact(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hashes_tell_windows_apart():
    h = np.random.default_rng(5).integers(0, 2**63, 300).astype(np.uint64)
    h[200:240] = h[20:60]
    for window in (2, 3, 5, 13):
        e = edge_hashes(h, window)
        assert len(e) == 300 - window + 1 and len(set(e.tolist())) == len(e) - (40 - window + 1)
        assert (e[200:240 - window + 1] == e[20:60 - window + 1]).all()
        n = node_hashes(h, window - 1)
        assert len(pair_hashes(n)) == len(e) and len(set(pair_hashes(n).tolist())) == len(set(e.tolist()))
    assert not len(edge_hashes(h[:12], 13)) and not len(edge_hashes(h[:11], 13)) and not len(edge_hashes(h[:0], 13))
