"""Toxicity by multiple-instance learning: sentences are the instances, documents the bags.

A sentence's logit is a bias plus the weights of its distinct words and word beginnings. A document is toxic if any
sentence is: 1 - prod(1 - p) over sentences (noisy-or). Sentences without a learned feature say
nothing and take no part. The noisy-or is taken over the best RUN sentences in a row, of which a
shorter document has one: faint sentences, which any long text has, do not add up with its length.
Weights are learned from document labels alone, by gradient steps on the likelihood of that same
score with an L1 pull to zero, on a bounded sample. Scoring reads whole texts and also tells which sentence is the worst,
and where.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import ROWS_PER_SLICE, crc_bucket, fresh, held, materialise, table, tidy
from sigscore.llm._learning import labelled_rows

FOLDS, HELD_OUT_FOLD = 5, 0
DOCS_PER_CLASS = 2_000   # bound of the labelled sample
MIN_DOCS_WITH_WORD = 3   # of the sample
BEGINNINGS = (4, 5)
CACHE = 200_000          # remembered words per worker
STEPS, RATE, PULL = 150, 0.15, 2e-4
RUN = 30                 # sentences in a row whose scores are joined, in learning and in scoring
TASKS = 32               # that take the sample's texts apart
START_BIAS = -6.0
THRESHOLD = 0.5
SEED = 31
NOTHING = frozenset()    # shared by all words without a weight

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> set[str]:
    """A word and its beginnings, which inflected forms share."""
    return {word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)}


def sentence_spans(text: str):
    """(start, end) of the sentences: runs up to a stop or a line end."""
    return (m.span() for m in _SENTENCE.finditer(text))


class Model:
    """Word weights and bias. Without anything to learn from, every document scores 0."""

    def __init__(self, weights: dict[str, float] | None = None, bias: float = START_BIAS):
        self.weights, self.bias = weights or {}, bias
        self.seen: dict[str, frozenset] = {}

    def _known(self, word: str) -> frozenset:
        """The features of a word that carry a weight."""
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[word] = found = frozenset(f for f in features_of(word) if f in self.weights) or NOTHING
        return found

    def score(self, text: str):
        """(document score, start and end of the worst sentence, its score)."""
        mass, worst, where = [], -np.inf, (None, None)
        seen = self.seen
        for start, end in sentence_spans(text):
            hit = set()
            for w in _WORD.findall(text[start:end].lower()):
                found = seen.get(w)
                hit |= self._known(w) if found is None else found
            if not hit:
                mass.append(0.0)
                continue
            z = self.bias + sum(self.weights[w] for w in sorted(hit))
            mass.append(np.logaddexp(0.0, z))
            if z > worst:
                worst, where = z, (start, end)
        if where[0] is None:
            return 0.0, None, None, None
        upto = np.concatenate(([0.0], np.cumsum(mass)))
        total = (upto[RUN:] - upto[:-RUN]).max() if len(mass) > RUN else upto[-1]
        return -np.expm1(-total), *where, 1 / (1 + np.exp(-worst))


def _bag(text: str) -> list[set[str]]:
    """The sets of features of a text's sentences."""
    return [set().union(*map(features_of, _WORD.findall(text[a:b].lower()))) for a, b in sentence_spans(text)]


def _numbers(bag: list[set[str]], number: dict[str, int]) -> tuple[bytes, bytes]:
    """The numbers of the sentences' known features and how many each has, as 32-bit integers."""
    known = [sorted(number[w] for w in words if w in number) for words in bag]
    return (np.array([i for k in known for i in k], np.int32).tobytes(),
            np.array(list(map(len, known)), np.int32).tobytes())


def _bags(batch: pa.RecordBatch):
    """(doc_id, y, the sets of features of the sentences) of each row."""
    for doc_id, y, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "y", "text"))):
        yield doc_id, y, _bag(text or "")


def _vocabulary(rows: DataFrame) -> list[str]:
    """Features that MIN_DOCS_WITH_WORD documents of the sample have, sorted. Documents are counted in
    Spark; what reaches the driver has each feature once."""
    @tidy
    def features(batches):
        for batch in batches:
            for _, _, bag in _bags(batch):
                found = sorted(set().union(*bag))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found)], names=["feature"])

    counted = rows.mapInArrow(features, "feature string").groupBy("feature").agg(F.count("*").alias("n"))
    return [r["feature"] for r in counted.where(F.col("n") >= MIN_DOCS_WITH_WORD).orderBy("feature").collect()]


def _numbered(rows: DataFrame, vocabulary: list[str]) -> list:
    """(y, the numbers of the sentences' features, how many each sentence has), packed 32-bit integers,
    of each document of the sample."""
    @tidy
    def pack(batches):
        number = {w: i for i, w in enumerate(vocabulary)}
        for batch in batches:
            for doc_id, y, bag in _bags(batch):
                words, sizes = _numbers(bag, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([y], pa.int32()),
                     pa.array([words], pa.binary()), pa.array([sizes], pa.binary())],
                    names=["doc_id", "y", "words", "sizes"])

    packed = rows.mapInArrow(pack, "doc_id bigint, y int, words binary, sizes binary")
    return packed.orderBy("doc_id", "y", "words").select("y", "words", "sizes").collect()


def _best_runs(mass: np.ndarray, start: np.ndarray, end: np.ndarray):
    """For documents whose sentences are start..end: the largest sum of RUN sentences in a row (of
    all, if they are fewer), and which sentences are in it."""
    upto = np.concatenate(([0.0], np.cumsum(mass)))
    own = np.repeat(np.arange(len(start)), end - start)
    at = np.arange(len(mass))
    sums = upto[np.minimum(at + RUN, end[own])] - upto[at]
    total = np.maximum.reduceat(sums, start)
    hit = np.flatnonzero(sums >= total[own])
    _, first = np.unique(own[hit], return_index=True)
    begin = hit[first]
    inside = np.zeros(len(mass) + 1)
    np.add.at(inside, begin, 1)
    np.add.at(inside, np.minimum(begin + RUN, end), -1)
    return total, np.cumsum(inside[:-1])


def fit(rows: list, vocabulary: list[str]) -> Model:
    """Learns a model from packed rows (``_numbered``). A document's score is that of scoring: the
    noisy-or over its best run of sentences. In the first half of the steps all sentences of a run
    take part, so that weights can leave zero; then, as in scoring, those with a feature that
    carries a weight."""
    rows = [(r[0], np.frombuffer(r[1], np.int32), np.frombuffer(r[2], np.int32)) for r in rows]
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Model()
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both classes weigh alike
    rows, y, share = ([r for r in rows if len(r[2])], *(
        v[[len(r[2]) > 0 for r in rows]] for v in (y, share)))
    if not rows:
        return Model()
    word = np.concatenate([r[1] for r in rows])
    sizes = np.concatenate([r[2] for r in rows])
    end = np.cumsum([len(r[2]) for r in rows])
    start = np.concatenate(([0], end[:-1]))
    bag_of = np.repeat(np.arange(len(rows), dtype=np.int32), end - start)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del rows
    w, b = np.zeros(len(vocabulary)), START_BIAS
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, STEPS + 1):
        z = b + np.bincount(sentence, w[word], len(sizes))
        part = 1.0 if t <= STEPS // 2 else np.bincount(sentence, w[word] != 0, len(sizes)) > 0
        total, inside = _best_runs(np.logaddexp(0, z) * part, start, end)
        # loss: total for y = 0, -log(1 - exp(-total)) for y = 1
        slope = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0) * share
        dz = slope[bag_of] / (1 + np.exp(-z)) * part * inside
        g, gb = np.bincount(word, dz[sentence], len(w)), dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = RATE * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        scale = np.sqrt(v) + 1e-6
        w = w - step * m / scale
        w = np.sign(w) * np.maximum(np.abs(w) - step * PULL / scale, 0)  # the pull to zero
        b -= step * mb / (np.sqrt(vb) + 1e-6)
    return Model({k: float(x) for k, x in zip(vocabulary, w) if x}, float(b))


def fit_texts(rows: list) -> Model:
    """``fit`` for a few (y, text) rows that the caller holds."""
    bags = [_bag(text or "") for _, text in rows]
    seen = Counter(w for bag in bags for w in set().union(*bag))
    vocabulary = sorted(w for w, n in seen.items() if n >= MIN_DOCS_WITH_WORD)
    number = {w: i for i, w in enumerate(vocabulary)}
    return fit([(y, *_numbers(bag, number)) for (y, _), bag in zip(rows, bags)], vocabulary)


def train(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> Model:
    """Learns from labelled documents outside the held-out fold, at most ``per_class`` of each class.
    Texts are taken apart in tasks; numbers of frequent features alone reach the driver."""
    learn = crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD
    rows = materialise(labelled_rows(docs.select("doc_id", "text"), labels, "toxic", learn, per_class, SEED
                                     ).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text"),
                       "toxicity_sample").repartition(TASKS)
    vocabulary = _vocabulary(rows)
    return fit(_numbered(rows, vocabulary), vocabulary)


SCORES = "score double, worst_start int, worst_end int, worst_score double"


def scorer(model: Model):
    """A function of a text column: score, worst_start, worst_end, worst_score in one struct. A worker
    holds a slice of the texts at a time; the words it remembers serve its later tasks of this query."""
    query = fresh("toxicity")

    @tidy
    def score(batches):
        kept = held(query, lambda: model)
        for texts in batches:
            out = []
            for lo in range(0, len(texts), ROWS_PER_SLICE):
                out += [kept.score(t or "") for t in texts.slice(lo, ROWS_PER_SLICE).to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, (
                    pa.float64(), pa.int32(), pa.int32(), pa.float64()))],
                ["score", "worst_start", "worst_end", "worst_score"])

    from collections.abc import Iterator
    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(score, SCORES)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The input's columns and score, worst_start, worst_end, worst_score in one struct column
    ``toxicity``. Only the text goes into a score."""
    return docs.withColumn("toxicity", scorer(model)("text"))


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = DOCS_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst sentence's place and score, one row per
    input row.

    Null and empty texts score what no sentence scores: 0. A document without a learned word has
    no worst sentence (null). Rows with a null id are scored and never held out. Without labels
    of both classes every score is 0. Repeated rows get equal scores. Only ``doc_id`` and
    ``text`` are read, and of ``labels`` doc_id and toxic.
    """
    model = train(docs, labels, per_class)
    scored = score_documents(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "toxicity.*").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")).select(
        "doc_id", "held_out", "score", "predicted", "worst_start", "worst_end", "worst_score")


def op3(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
