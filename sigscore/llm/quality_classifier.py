"""Quality classifier by Bradley-Terry pairwise ranking.

Labelled documents give preference pairs: a good one before a bad one. The probability that one
is preferred is the logistic function of the difference of the two scores, which are linear in
the features, so fitting is logistic regression on feature differences, on a bounded sample. The
measures' means, scales and cuts are taken over all labelled learning rows, and the threshold is the
quantile of all their scores at the share of bad documents; the published score is the
logistic function of the distance to it, moved so that the threshold lies at 0.7.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import crc_bucket, materialise, table
from sigscore.llm._learning import labelled_rows

FOLDS, HELD_OUT_FOLD = 4, 2
DOCS_PER_CLASS = 3_000  # bound of the labelled sample
PAIRS = 30_000
STEPS, RATE, RIDGE = 400, 0.05, 1e-3
BINS = 6                # each measure is also cut at its quantiles
ACCURACY = 100_000      # a quantile's rank is at most a share of 1 / ACCURACY off
THRESHOLD = 0.7
MARKS = "#*$%&|<>!?"
SEED = 41


def measures(text: str | None) -> list[float]:
    """What is measured of a text: sizes, character shares, repetition of words and lines."""
    text = text or ""
    n = max(1, len(text))
    ws = text.split()
    m = max(1, len(ws))
    lines = [x for x in text.split("\n") if x.strip()]
    count = Counter(text)
    upper = sum(c for ch, c in count.items() if ch.isupper())
    letters = sum(c for ch, c in count.items() if ch.isalpha())
    digits = sum(c for ch, c in count.items() if ch.isdigit())
    words = Counter(ws)
    pairs = len(set(zip(ws, ws[1:])))
    stops = sum(c for ch, c in count.items() if ch in ".,")
    return [np.log1p(len(ws)), len(text) / m, letters / n, upper / max(1, letters), digits / n,
            *[count[c] / m for c in MARKS], stops / m,
            1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(ws) / max(1, len(lines))),
            len(words) / m, 1 - pairs / max(1, len(ws) - 1) if len(ws) > 1 else 0.0,
            max(words.values(), default=0) / m,
            sum(c for w, c in words.items() if not any(ch.isalpha() for ch in w)) / m]


class Model:
    """Standardised measures and their bins, weighed; ``threshold`` in units of the raw score."""

    def __init__(self, cuts, mean, scale, weights, threshold):
        self.cuts, self.mean, self.scale = cuts, mean, scale
        self.weights, self.threshold = weights, threshold

    def features(self, x: np.ndarray) -> np.ndarray:
        binned = [x[:, [i]] > c[None, :] for i, c in enumerate(self.cuts) if len(c)]
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z, *[b.astype(float) for b in binned]])

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.features(x) @ self.weights
        odds = raw - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def fit(y, x, cuts, mean, scale) -> Model:
    """Learns weights from the classes and measures of the sample; the threshold is left at 0."""
    model = Model(cuts, mean, scale, None, 0.0)
    f = model.features(x)
    rng = np.random.default_rng(SEED)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    diff = f[rng.choice(good, PAIRS)] - f[rng.choice(bad, PAIRS)]
    w, m, v = np.zeros(f.shape[1]), 0.0, 0.0
    for t in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -60, 60)))  # of preferring the bad one
        g = RIDGE * w - diff.T @ p / PAIRS
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    model.weights = w
    return model


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x (the measures) of every document: texts are read once, and never shuffled."""
    def measure(batches):
        for texts in batches:
            yield pa.array([[float(v) for v in measures(t)] for t in texts.to_pylist()],
                           pa.list_(pa.float64()))

    measure.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return materialise(docs.select("doc_id", F.arrow_udf(measure, "array<double>")("text").alias("x")),
                       "quality_measures")


def statistics(rows: DataFrame, n: int):
    """(cuts, mean, scale) of the ``n`` measures."""
    at = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, BINS + 1)[1:-1]])
    x = [F.col("x")[i] for i in range(n)]
    got = rows.agg(F.array(*[F.percentile_approx(c, at, ACCURACY) for c in x]).alias("cuts"),
                   F.array(*[F.avg(c) for c in x]).alias("mean"),
                   F.array(*[F.stddev_pop(c) for c in x]).alias("scale")).first()
    return ([np.unique(c) for c in got["cuts"]], np.round(got["mean"], 9),
            np.round(got["scale"], 9) + 1e-9)


def threshold_of(rows: DataFrame, model: Model, bad_share: float) -> float:
    """The quantile of the rows' raw scores at ``bad_share``, between two scores."""
    def raw(batches):
        for x in batches:
            f = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else None
            yield pa.array([] if f is None else model.features(f) @ model.weights, pa.float64())

    raw.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    scores = materialise(rows.select(F.arrow_udf(raw, "double")("x").alias("raw")), "quality_raw")
    q = scores.agg(F.percentile_approx("raw", F.lit(float(bad_share)), ACCURACY)).first()[0]
    low, high = scores.agg(F.max(F.when(F.col("raw") <= q, F.col("raw"))),
                           F.min(F.when(F.col("raw") > q, F.col("raw")))).first()
    return low if high is None else (low + high) / 2


def train(rows: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> Model | None:
    """Learns from measured documents (``measured``) outside the held-out fold; None without rows of
    both classes. Weights are learned from at most ``per_class`` documents of each class; the share
    of bad documents is counted over all labels there, and statistics and threshold are taken over
    all labelled documents there."""
    learn = crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD
    # 2 * per_class rows of two dozen numbers; documents that share an id are all taken
    sample = labelled_rows(rows, labels, "quality", learn, per_class, SEED).select("y", "x").orderBy(
        "doc_id", "y", "x").limit(4 * per_class).collect()
    y = np.array([r["y"] for r in sample])
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in sample])
    bad = labels.where(learn).agg(F.avg((F.col("quality") == 0).cast("double"))).first()[0]
    ids = labels.where(learn & F.col("quality").cast("int").isin(0, 1)).select("doc_id").distinct()
    known = rows.join(ids, "doc_id").select("x")
    model = fit(y, x, *statistics(known, x.shape[1]))
    model.threshold = threshold_of(known, model, bad or 0.0)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.7), one row per input row.

    Null and empty texts are scored on their (zero) measures. Rows with a null id are scored and
    never held out. Without labels of both classes every document scores 1. Repeated rows get
    equal scores; ties at the threshold are predicted 1. Only ``doc_id`` and ``text`` are read,
    and of ``labels`` doc_id and quality.
    """
    rows = measured(docs)
    model = train(rows, labels, per_class)

    def score(batches):
        for x in batches:
            if model is None or not len(x):
                yield pa.array([1.0] * len(x), pa.float64())
            else:
                yield pa.array(model.score(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)),
                               pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"),
                       F.arrow_udf(score, "double")("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
