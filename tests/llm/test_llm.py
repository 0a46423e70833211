"""The training-data operators against brute force, SQL and held-out rows, and on awkward input:
nulls, empty and long texts, ties and repeated rows, empty tables, clashing extra columns."""

import collections
import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF_SMALL
from sigscore.llm import (language_id, mixing, near_dedup, neighbours, packing,
                          quality_classifier, quality_rules, substring_dedup, toxicity, url_filter)
from sigscore.llm._common import materialise, table
from sigscore.llm.components import connected_components
from sigscore.llm.de_bruijn import steps
from tools.oracle_check import duck

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size int, score string, kept string, block string")
LONG = " ".join(f"wort{i % 5000}" for i in range(30_000))
AWKWARD = [
    (1, None, None, None, None, 1, "s", "k", "b"), (2, "", "en", "a", 0, 1, "s", "k", "b"),
    (3, " \t\n ", "en", "a", 4, 1, "s", "k", "b"), (4, "one", "en", "a", 3, 1, "s", "k", "b"),
    (5, "one", "en", None, 3, 1, "s", "k", "b"), (5, "one", "en", None, 3, 1, "s", "k", "b"),
    (None, "no id here", "en", "b", 10, 1, "s", "k", "b"), (6, LONG, "en", "b", 0, 1, "s", "k", "b"),
    (7, LONG, "de", "c", 0, None, None, None, None), (8, "12 34 !!", "fr", "c", 8, 1, "s", "k", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF_SMALL, "labels")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def words(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- near duplicates
def brute_components(sets, percent=85):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n=3):
    w = [x.decode("utf-8", "ignore") for x in words(text)]
    w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in w]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_near_duplicates_equal_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    want = brute_components(sets)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_large_group_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "DOCS_PER_CHUNK", 8)
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        t = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            t[at] = f"x{i}_{at}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()}
    want = brute_components({i: shingles(t) for i, t in rows})
    # tables may miss a pair at the threshold; with 60 copies of one text none is left alone
    assert got == want


def test_near_duplicates_awkward(awkward, spark):
    got = near_dedup.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    by = {r["doc_id"]: r for r in got}
    assert by[5]["component_id"] == 4 and not by[5]["kept"] and by[7]["component_id"] == 6
    assert by[1]["n_shingles"] == by[2]["n_shingles"] == by[3]["n_shingles"] == 0
    assert by[2]["kept"] and by[None]["kept"] and by[None]["component_id"] is None
    assert near_dedup.near_duplicates(awkward.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 100), (7, 7), (3, 2)]
    got = dict(connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[105] == got[101] == 100


def test_components_of_long_paths(spark):
    n = 3_000
    ids = np.random.default_rng(6).permutation(n).tolist()
    falling = [n, *range(2 * n, n, -1)]  # the smallest id lies beyond a descending run
    edges = [*zip(ids, ids[1:]), *zip(falling, falling[1:])]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 if i < n else n for i in range(2 * n + 1)}


# ---------------------------------------------------------------- quality rules
def brute_base(text):
    w = words(text)
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    seen = {j for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(seen))


def test_quality_rules(docs, texts, awkward, labels):
    got = quality_rules.quality_rules(docs.select("doc_id", "text")).toPandas().set_index("doc_id")
    for i, t in texts.items():
        assert tuple(got.loc[i, list(quality_rules.BASE)]) == brute_base(t)
    failed = (got.n_words < 20) | (100 * got.n_repeat_words > 30 * got.n_words)
    assert (got.base_failed == failed).all() and not (got.kept & got.base_failed).any()
    odd = quality_rules.quality_rules(awkward).collect()
    assert len(odd) == len(AWKWARD)
    assert all(tuple(r[c] for c in quality_rules.BASE) == brute_base(
        next(a[1] for a in AWKWARD if a[0] == r["doc_id"])) for r in odd)
    assert quality_rules.quality_rules(awkward.limit(0)).count() == 0


def test_repeats_inside_one_text(spark):
    w = "a b c d e f g h i j".split()
    cases = {1: w + w, 2: w * 3 + ["z"], 3: ["q"] * 30, 4: w[:7] + ["|"] + w[:7], 5: w + ["x"] + w[:8]}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in cases.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.base_measures(df).collect()}
    assert got == {i: brute_base(" ".join(t))[4] for i, t in cases.items()}


def test_em_finds_a_useless_rule():
    names = ["sharp", "weak"]
    rows = [{"sharp": s, "weak": k, "n": n} for s, k, n in
            [(1, 1, 850), (1, -1, 40), (-1, 1, 5), (-1, -1, 105), (0, 0, 10)]]
    acc = quality_rules.estimate_accuracies(rows, names)
    assert 0.8 < acc.prior < 0.95 and acc.on_good["sharp"] > 0.95 and acc.on_bad["sharp"] > 0.8
    assert quality_rules.estimate_accuracies([], names).prior == quality_rules.PRIOR_GOOD


def test_em_gives_a_coin_no_weight():
    """Votes drawn from known rates: three rules that know something and a coin."""
    names, pick = ["sharp", "fair", "weak", "coin"], np.random.default_rng(5)
    rates = {"sharp": (.98, .9), "fair": (.95, .7), "weak": (.8, .6), "coin": (.5, .5)}
    good = pick.random(20_000) < 0.8
    votes = [np.where(pick.random(len(good)) < np.where(good, g, 1 - b), 1, -1)
             for g, b in rates.values()]
    counts = collections.Counter(zip(*(v.tolist() for v in votes)))
    rows = [dict(zip(names, k), n=n) for k, n in sorted(counts.items())]
    acc = quality_rules.estimate_accuracies(rows, names, steps=200)
    assert abs(acc.prior - 0.8) < 0.03
    for r, (g, b) in rates.items():
        assert abs(acc.on_good[r] - g) < 0.05 and abs(acc.on_bad[r] - b) < 0.05, r
    _, ratios = acc.log_ratios()
    assert all(abs(x) < 0.1 for x in ratios["coin"])
    # the other way round, the classes are still named by their votes
    turned = [{**{r: -row[r] for r in names}, "n": row["n"]} for row in rows]
    other = quality_rules.estimate_accuracies(turned, names, steps=200)
    assert all(other.on_good[r] + other.on_bad[r] > 0.98 for r in names) and other.prior < 0.25


def test_verdicts_against_labels(docs, labels):
    got = quality_rules.quality_rules(docs).join(labels, "doc_id").where("not base_failed").groupBy(
        "quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n[0, False] >= n.get((0, True), 0)


# ---------------------------------------------------------------- learned scores
def test_toxicity(docs, labels, awkward):
    got = toxicity.toxicity(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    seen = got[~got.held_out]
    assert (seen.toxic == seen.predicted).mean() > 0.95
    model = toxicity.fit_texts([(1, f"fine words. you are a grobian{i}. good day")
                          if i % 2 else (0, f"fine words. good day {i}.") for i in range(60)])
    text = "good day. what a grobianism! fine words."
    score, start, end, _ = model.score(text)
    assert score > 0.5 and "grobianism" in text[start:end] and model.score("good day.")[0] < 0.5
    odd = toxicity.toxicity(awkward, labels).collect()
    assert len(odd) == len(AWKWARD) and {r["score"] for r in odd if r["doc_id"] in (1, 2)} == {0.0}
    assert toxicity.toxicity(awkward, labels.limit(0)).count() == len(AWKWARD)
    assert toxicity.toxicity(awkward.limit(0), labels).count() == 0


def test_long_clean_text_is_kept(spark, docs, labels, texts):
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("toxic = 0 and predicted = 0")
    clean = "\n".join(texts[r["doc_id"]] for r in rows.select("doc_id").orderBy("doc_id").collect())
    clean = "\n".join([clean] * (1 + 30_000 // sum(1 for _ in toxicity.sentence_spans(clean))))
    long = spark.createDataFrame([(-1, clean), (-2, "Zqx vkj. " * 30_000)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(long)
    kept = {r["doc_id"] for r in P.toxicity(spark, both, SF_SMALL).select("doc_id").collect()}
    assert {-1, -2} <= kept
    assert {r["score"] for r in toxicity.toxicity(long, labels.limit(0)).collect()} == {0.0}
    model = toxicity.fit_texts([(1, f"fine words. you are a grobian{i}. good day")
                          if i % 2 else (0, f"fine words. good day {i}.") for i in range(60)])
    text = "good day. fine words. " * 10_000
    assert model.score(text)[0] < 0.5 < model.score(text + "you are a grobian. " + text)[0]


def test_quality_classifier(docs, labels, awkward):
    got = quality_classifier.quality_scores(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert (got[got.held_out].quality == got[got.held_out].predicted).mean() > 0.85
    odd = quality_classifier.quality_scores(awkward, labels).collect()
    assert len(odd) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in odd)
    none = quality_classifier.quality_scores(awkward, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {1.0}
    assert quality_classifier.quality_scores(awkward.limit(0), labels).count() == 0


def test_quality_statistics_over_all_rows(docs, labels, texts):
    model = quality_classifier.train(quality_classifier.measured(docs), labels, per_class=4)
    y = {r["doc_id"]: r["quality"] for r in labels.collect()
         if r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    x = np.array([quality_classifier.measures(texts[i]) for i in y])
    assert len(x) > 8 and np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0))
    below = (model.features(x) @ model.weights < model.threshold).mean()
    assert abs(below - np.mean([v == 0 for v in y.values()])) <= 1 / len(x) + 1e-9


def test_forward_sums_all_segmentations():
    model = language_id.Unigrams(["x"], {b" ": (.1,), b"a": (.2,), b"b": (.3,), b"ab": (.4,), b" a": (.5,)})
    # " ab": [ ,a,b] [ ,ab] [ a,b]
    assert np.isclose(np.exp(model.word("ab")[0]), .1 * .2 * .3 + .1 * .4 + .5 * .3)
    used = language_id.expected_pieces(b" ab", {k: np.log(v[0]) for k, v in model.table.items()}, 2)
    assert np.isclose(used[b" a"], .15 / .196) and np.isclose(used[b"a"], .006 / .196)


def test_language_id(docs, awkward):
    got = language_id.language_id(docs).toPandas().merge(docs.toPandas()[["doc_id", "lang"]], on="doc_id")
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    odd = {r["doc_id"]: r for r in language_id.language_id(awkward).collect()}
    assert all(odd[i]["lang_pred"] == "und" and odd[i]["score"] == 0 for i in (1, 2, 3, 8))
    assert language_id.language_id(awkward.limit(0)).count() == 0


# ---------------------------------------------------------------- mixing
def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    cut, budget = set(), 1.5 * sum(sizes.values())
    while True:
        left = budget - sum(2 * sizes[s] for s in cut)
        total = sum(weight[s] for s in names if s not in cut)
        t = {s: 2.0 * sizes[s] if s in cut else left * weight[s] / total for s in names}
        new = {s for s in names if t[s] > 2 * sizes[s]}
        if not new:
            return t
        cut |= new


def test_mixing(docs, texts):
    sized, plan = mixing.plan_mix(docs)
    got = mixing._with_places(sized, plan).toPandas()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert dict(zip(got.doc_id, got["size"])) == {i: len(words(t)) for i, t in texts.items()}
    sizes = collections.Counter()
    for i, t in texts.items():
        sizes[source[i]] += len(words(t))
    want = brute_targets(dict(sizes))
    taken = collections.Counter()
    for r in got.itertuples():
        assert np.isclose(r.target, want[source[r.doc_id]]) and len(r.places) <= 2
        taken[source[r.doc_id]] += r.size * len(r.places)
    big = got.groupby(got.doc_id.map(source))["size"].max()
    assert all(abs(taken[s] - want[s]) <= big[s] / 2 + 1 for s in want)
    shards = collections.Counter(p["shard"] for x in got.places for p in x)
    assert max(shards.values()) - min(shards.values()) <= 12
    again = mixing._with_places(*mixing.plan_mix(docs.repartition(5))).toPandas()
    assert dict(zip(got.doc_id, got.places.map(len))) == dict(zip(again.doc_id, again.places.map(len)))


def test_mixing_awkward(awkward):
    out = mixing.mix_documents(awkward)
    assert out.columns == awkward.columns and out.count() > 0
    assert mixing.mix_documents(awkward.limit(0)).count() == 0


def test_near_dedup_equals_sql(docs):
    sql = duck(SF_SMALL).sql(near_dedup.OP1_SQL).df()
    got = near_dedup.near_duplicates(docs).toPandas()
    cols = ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(sql[cols].itertuples(index=False, name=None)) == sorted(
        got[cols].itertuples(index=False, name=None))


# ---------------------------------------------------------------- substring dedup
def brute_cut(rows, k=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - k + 1):
            x = tuple(w[p:p + k])
            first[x] = min(first.get(x, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = {q for p in range(len(w) - k + 1) if first[tuple(w[p:p + k])] < i for q in range(p, p + k)}
        left = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return out


def test_substring_dedup(docs, texts, monkeypatch, spark):
    monkeypatch.setattr(substring_dedup, "EDGES_PER_TASK", 3000)  # several packs a task
    monkeypatch.setattr(substring_dedup, "BYTES_PER_PART", 50_000)
    monkeypatch.setattr(substring_dedup, "BYTES_PER_BUCKET", 90_000)
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.find_repeats(docs).select(*cols).collect()}
    assert got == brute_cut(list(texts.items()))
    sql = duck(SF_SMALL).sql(substring_dedup.OP5_SQL).df()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in sql.itertuples()} == got


def test_refused_windows_stay(spark, monkeypatch):
    t = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, t), (2, "x " + t)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.find_repeats(df).collect()} == {1: 0, 2: 20}
    refuse = lambda docs, spans, window: steps(spans.select(
        F.col("path").alias("walk"), F.explode("pieces.nodes").alias("nodes"))).where(
        "after IS NOT NULL").select(F.col("node").alias("u"), F.col("after").alias("v"))
    monkeypatch.setattr(substring_dedup, "_refused", refuse)
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.find_repeats(df).collect()} == {1: 0, 2: 0}


def test_source_id_with_several_texts(spark):
    p, q = (" ".join(f"{x}{i}" for i in range(20)) for x in "pq")
    rows = [(1, p), (1, q), (1, None), (5, p), (6, q + " " + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r)[:4] for r in substring_dedup.find_repeats(df).where("doc_id > 1").collect()]
    want = brute_cut([r for r in rows if r[1]])
    assert {r[0]: r[1:] for r in got} == {i: want[i] for i in (5, 6)} and want[5][1] == 20
    # checks that no row of the source has are still refused
    spans = spark.createDataFrame([(1, 7, [(0, [11, 12, 13])]), (1, 8, [(0, [12, 13])])],
                                  "source long, path long, pieces array<struct<place:long, nodes:array<long>>>")
    refused = substring_dedup._refused(df, spans, substring_dedup.WINDOW).collect()
    assert sorted(map(tuple, refused)) == [(11, 12), (12, 13)]


def test_substring_awkward(awkward):
    got = substring_dedup.find_repeats(awkward).toPandas()
    assert len(got) == len(AWKWARD)
    assert got.set_index("doc_id").n_removed.to_dict()[7] == 30_000 and got.n_removed.sum() == 30_000
    out = substring_dedup.remove_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == len(AWKWARD)
    assert out.where("doc_id = 7").first()["text"] == "" and out.where("doc_id = 6").first()["text"] == LONG
    assert substring_dedup.find_repeats(awkward.limit(0)).count() == 0


# ---------------------------------------------------------------- neighbours
def test_neighbours(spark):
    rows = table(spark, SF_SMALL, "embeddings").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    got = neighbours.nearest_neighbours(table(spark, SF_SMALL, "embeddings")).toPandas()
    found = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        found += len(set(best) & set(g.vec_id))
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 11)) and list(g.score) == sorted(g.score)
        assert np.allclose(g.score, [d[ids == v][0] for v in g.vec_id])
    queries = (ids % 100 == 0).sum()
    assert got.query_id.nunique() == queries and found >= 9 * queries


def test_neighbours_awkward(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [0.0, 0.0]),
            (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, []), (None, [1.0, 1.0]), (2, [0.9, 0.1]),
            (100, [1.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in neighbours.nearest_neighbours(df).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 100), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0


# ---------------------------------------------------------------- urls
def test_urls(spark):
    urls = ["https://A.Net/x?y", "http://example.net/en/1", "http://m.example.net/en", "ftp://x.org/fr/",
            "http://example.com/de/q", "http://example.com/en/q", "http://badnet/a", "no scheme/net/",
            None, "", "http://net?x", "http://NET/", "a://b.net/en#://c"]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, rule int")
    got = {r["page_id"]: tuple(r)[1:5] for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block") and got[1][2:] == ("example.net/en/", "allow")
    assert got[2][2:] == ("net/", "block") and got[3] == ("x.org", "/fr/", "org/fr/", "allow")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2] is None and got[6][2] is None
    assert got[7][:3] == got[8][:3] == ("", "", None) and got[10][:3] == ("net", "", None)
    assert got[11][2:] == ("net/", "block") and got[12][:3] == ("b.net", "/en", "net/")
    assert all(v[3] in ("allow", "block") for v in got.values()) and len(got) == len(urls)
    assert url_filter.judge_urls(df.limit(0)).count() == 0
    only = url_filter.judge_urls(df.where("page_id in (0, 5)")).collect()
    assert {r["verdict"] for r in only} == {"block"}


# ---------------------------------------------------------------- packing
def check_packed(rows, capacity):
    used = collections.defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_packing_round_trip(docs, texts, awkward, spark):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_path())
    odd = {10**6: "two  spaces\n\n new\u00a0line \x1f x", 10**6 + 1: " lead", 10**6 + 2: "tail ",
           10**6 + 3: "it's <|endoftext|> a\tb\r\nc", 10**6 + 4: "\u00e9\u4e2d\n\u3000x a\n b"}
    extra = spark.createDataFrame(list(odd.items()), "doc_id long, text string")
    whole.encode_special_tokens = True
    rows = packing.pack_documents(docs.select("doc_id", "text").unionByName(extra)).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, t in {**texts, **odd}.items():
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == 2048 for p in pieces[1:]) and (len(ids) > 2048 or len(pieces) == 1)
        for p in pieces:
            part = ids[p["start"]:p["start"] + p["length"]]
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    n = check_packed(rows, 2048)
    total = sum(r["length"] for r in rows)
    assert n <= total / 2048 * 1.12 + 2
    assert packing.pack_documents(awkward.limit(0)).count() == 0
    some = packing.pack_documents(awkward).collect()
    assert sorted(r["length"] for r in some if r["doc_id"] in (1, 2)) == [1, 1]


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(3)
    lengths = sorted(rng.integers(1, 65, 400).tolist(), reverse=True)
    bins, left = packing.BestFit(64), []
    for n in lengths:
        fits = [x for x in left if x >= n]
        _, offset = bins.place(n)
        if fits:
            left.remove(min(fits))
        assert offset == 64 - (min(fits) if fits else 64)
        left.append((min(fits) if fits else 64) - n)
    assert bins.used == len(left)


# ---------------------------------------------------------------- pipeline
def test_stages(spark, docs, awkward):
    kept = docs
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept, SF_SMALL)
        assert out.columns == docs.columns, name
        kept = materialise(out, f"test_{name}")  # as the pipeline does
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]


def test_stages_on_awkward_rows(spark, awkward):
    assert P.toxicity(spark, awkward, SF_SMALL).count() == len(AWKWARD)
    near = P.near_dedup(spark, awkward, SF_SMALL)
    assert near.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in near.collect()) == [0, 1, 2, 3, 4, 6, 8]
    cut = P.substring_dedup(spark, awkward, SF_SMALL)
    assert cut.columns == awkward.columns and cut.count() == len(AWKWARD) - 1  # 7 is all repeats
    for _, stage in P.STAGES:
        assert stage(spark, awkward.limit(0), SF_SMALL).count() == 0


def test_near_dedup_of_ids_with_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (9, a), (9, b), (9, b), (3, c), (7, c + " z"), (7, "q r s t u v"), (12, b), (13, None),
            (13, ""), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in P.near_dedup(spark, df, SF_SMALL).collect()]
    want = [(5, a), (9, b), (3, c), (7, "q r s t u v"), (13, None), (13, ""), (None, a)]
    assert collections.Counter(kept) == collections.Counter(want)
    got = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {(5, 5), (9, 5), (12, 5), (3, 3), (7, 3), (13, 13), (None, None)}
