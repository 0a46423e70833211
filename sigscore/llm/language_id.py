"""Language identification with segmentation-marginalised unigrams.

Per language, each piece of a fixed public vocabulary has a probability. A word's probability is
the sum over all ways to cut it into pieces, by a forward pass over its bytes; a text's is the
product over its words (pieces start at a word at the earliest, so nothing is lost by going word
by word). Piece probabilities are estimated by expectation-maximisation on word counts of a
bounded sample of learning documents per language: Spark counts words, expected piece counts are
computed and pre-aggregated in tasks, and the vocabulary bounds what comes back.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigscore.llm._common import crc_bucket, materialise, table
from sigscore.llm.packing import tokenizer_path

FOLDS, HELD_OUT_FOLD = 4, 2
DOCS_PER_LANGUAGE = 1_500  # bound of the learning sample
SPARE = 2                  # ids that a language's hash bound lets through, times its sample
EM_STEPS = 2
FLOOR = 1e-7               # each piece's least probability
CACHE = 200_000            # remembered words per worker
WORDS_AT_ONCE = 8_192      # words that one forward pass goes over
LEAST_CHANCE = 1e-280      # words whose chance may fall below are summed in logarithms
UNKNOWN = "und"
SEED = 51

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")


def public_pieces(path: str | None = None) -> list[bytes]:
    """The vocabulary's pieces as bytes; all single bytes are among them, so every word can be
    cut. Pieces are stored with printable stand-ins for bytes, as byte-level files are."""
    from tokenizers import Tokenizer
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in, extra = {chr(b): b for b in printable}, 256
    for b in range(256):
        if b not in printable:
            stand_in[chr(extra)] = b
            extra += 1
    vocabulary = Tokenizer.from_file(path or tokenizer_path()).get_vocab()
    pieces = {bytes(stand_in[c] for c in p) for p in vocabulary if all(c in stand_in for c in p)}
    return sorted(pieces | {bytes([b]) for b in range(256)})


def words_of(text: str) -> list[str]:
    """Runs of letters and the marks on them, lower-cased; numbers and number forms are none."""
    return _WORD.findall(text.lower())


def _spaced(word: str) -> bytes:
    """A word's bytes with the leading space that starts a piece."""
    return b" " + word.encode()


class Unigrams:
    """Piece probabilities of several languages: piece -> one number per language."""

    def __init__(self, languages: list[str], table: dict[bytes, tuple]):
        self.languages = languages
        self.longest = max(map(len, table), default=1)
        # row 0, all zero, is that of byte strings which are not a piece
        self.at = {p: i for i, p in enumerate(table, 1)}
        self.rows = np.array([(0.0,) * len(languages), *table.values()]).reshape(
            len(table) + 1, len(languages))
        with np.errstate(divide="ignore"):
            self.logs = np.log(self.rows)
        least = self.rows[self.rows > 0].min(initial=0.5)
        # so many bytes cannot take a product of probabilities below LEAST_CHANCE
        self.short = int(math.log(LEAST_CHANCE) / math.log(min(least, 0.5)))

    @property
    def table(self) -> dict[bytes, tuple]:
        return {p: tuple(self.rows[i]) for p, i in self.at.items()}

    def word(self, word: str) -> np.ndarray:
        """Log probability of a word per language."""
        return self.words([word])[0]

    def words(self, words: list[str]) -> np.ndarray:
        """Log probabilities, words x languages. A forward pass goes over many words at a
        time, longest first, so that those which reach a byte are always the first ones."""
        order = sorted(((_spaced(w), i) for i, w in enumerate(words)),
                       key=lambda x: len(x[0]), reverse=True)
        total = np.zeros((len(words), len(self.languages)))
        split = sum(len(b) > self.short for b, _ in order)
        for lo, hi, sums in ((0, split, self._log_sums), (split, len(order), self._sums)):
            for at in range(lo, hi, WORDS_AT_ONCE):
                some = order[at:min(hi, at + WORDS_AT_ONCE)]
                total[[i for _, i in some]] = sums([b for b, _ in some])
        return total

    def _sums(self, some: list[bytes]) -> np.ndarray:
        """Forward pass in plain probabilities, for words that cannot underflow."""
        size = np.array([len(b) for b in some])
        ahead = np.zeros((size[0] + 1, len(some), len(self.languages)))
        ahead[0] = 1.0
        for end in range(1, size[0] + 1):
            reach = int(np.searchsorted(-size, -end, "right"))
            for start in range(max(0, end - self.longest), end):
                row = np.fromiter([self.at.get(b[start:end], 0) for b in some[:reach]], np.int64, reach)
                hit = np.flatnonzero(row)
                ahead[end, hit] += ahead[start, hit] * self.rows[row[hit]]
        with np.errstate(divide="ignore"):
            return np.log(ahead[size, np.arange(len(some))])

    def _log_sums(self, some: list[bytes]) -> np.ndarray:
        """The same in logarithms, for words of any length. Only the positions that a piece can
        still reach back to are held, in a ring."""
        size = np.array([len(b) for b in some])
        ring = self.longest + 1
        ahead = np.full((ring, len(some), len(self.languages)), -np.inf)
        ahead[0] = 0.0
        out = np.zeros((len(some), len(self.languages)))
        with np.errstate(divide="ignore", invalid="ignore"):
            for end in range(1, size[0] + 1):
                reach = int(np.searchsorted(-size, -end, "right"))
                starts = range(max(0, end - self.longest), end)
                row = np.fromiter((self.at.get(b[start:end], 0) for b in some[:reach]
                                   for start in starts), np.int64, reach * len(starts))
                used = row > 0
                used[len(starts) - 1::len(starts)] = True  # each word has a place in the sums
                hit = np.flatnonzero(used)
                word, start = hit // len(starts), starts[0] + hit % len(starts)
                terms = ahead[start % ring, word] + self.logs[row[hit]]
                first = np.searchsorted(word, np.arange(reach))
                top = np.maximum.reduceat(terms, first, axis=0)
                parts = np.where(np.isfinite(terms), np.exp(terms - top[word]), 0.0)
                ahead[end % ring, :reach] = top + np.log(np.add.reduceat(parts, first, axis=0))
                done = np.flatnonzero(size[:reach] == end)
                out[done] = ahead[end % ring, done]
        return out


def expected_pieces(b: bytes, logs: dict[bytes, float], longest: int) -> dict[bytes, float]:
    """Expected number of times each piece is used in a random segmentation of ``b``, from the
    pieces' log probabilities. Sums stay logarithms, so no length underflows."""
    n = len(b)

    def log_sum(terms):
        top = max(terms, default=-math.inf)
        return top if top == -math.inf else top + math.log(sum(math.exp(t - top) for t in terms))

    ahead = [0.0]
    for end in range(1, n + 1):
        ahead.append(log_sum([ahead[start] + logs[piece] for start in range(max(0, end - longest), end)
                              if (piece := b[start:end]) in logs]))
    behind = [-math.inf] * n + [0.0]
    out: dict[bytes, float] = defaultdict(float)
    for start in range(n - 1, -1, -1) if ahead[n] > -math.inf else ():
        found = [(piece, logs[piece] + behind[start + len(piece)])
                 for end in range(start + 1, min(n, start + longest) + 1)
                 if (piece := b[start:end]) in logs]
        behind[start] = log_sum([x for _, x in found])
        for piece, x in found:
            out[piece] += math.exp(ahead[start] + x - ahead[n])
    return out


def _word_counts(sample: DataFrame) -> DataFrame:
    """(lang, word, n), counted in tasks first."""
    def count(batches):
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[lang].update(words_of(text or ""))
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                    names=["lang", "word", "n"])

    return sample.mapInArrow(count, "lang string, word string, n bigint").groupBy(
        "lang", "word").agg(F.sum("n").alias("n"))


def _em_step(counts: DataFrame, model: dict[str, dict[bytes, float]], longest: int) -> DataFrame:
    """Expected piece counts (lang, piece, n) under the model."""
    def expect(batches):
        logs: dict[str, dict] = {}
        for batch in batches:
            sums: dict[tuple, float] = defaultdict(float)
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in logs:
                    logs[lang] = {p: math.log(x) for p, x in model[lang].items()}
                for piece, x in expected_pieces(_spaced(word), logs[lang], longest).items():
                    sums[lang, piece] += n * x
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in sums], pa.string()),
                     pa.array([k[1] for k in sums], pa.binary()),
                     pa.array(list(sums.values()), pa.float64())], names=["lang", "piece", "n"])

    return counts.mapInArrow(expect, "lang string, piece binary, n double").groupBy(
        "lang", "piece").agg(F.sum("n").alias("n"))


def _sample_ids(docs: DataFrame, per_language: int) -> DataFrame:
    """(doc_id, l): the ``per_language`` smallest hashes of the ids of each language outside the
    held-out fold. An estimate of each language's ids (5 % off as a rule) bounds the hashes
    first, so some SPARE * per_language distinct ids of a language are ranked at any size."""
    learn = (crc_bucket(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD) & F.col("lang").isNotNull()
    ids = docs.where(learn).select("doc_id", F.col("lang").alias("l"))
    counts = materialise(ids.groupBy("l").agg(
        F.approx_count_distinct("doc_id").alias("n")), "language_sizes")
    hashed = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    # the hash as a number from 0 to 1; the smallest hashes as signed numbers come first
    place = (F.shiftright(hashed, 11) + F.lit(2**52)) / F.lit(2.0**53)
    near = ids.join(counts, "l").where(
        place * F.col("n") <= SPARE * per_language + 100).distinct()
    first = Window.partitionBy("l").orderBy(hashed, F.col("doc_id"))
    return near.withColumn("rank", F.row_number().over(first)).where(
        F.col("rank") <= per_language).select("doc_id", "l")


def train(docs: DataFrame, path: str | None = None, per_language: int = DOCS_PER_LANGUAGE) -> Unigrams:
    """Learns from documents with a language outside the held-out fold, those of at most
    ``per_language`` ids of each language (smallest hashes of the id)."""
    ids = materialise(_sample_ids(docs, per_language), "language_ids")
    d = docs.select("doc_id", "lang", "text").alias("d")
    same = (F.col("d.doc_id") == F.col("i.doc_id")) & (F.col("d.lang") == F.col("i.l"))
    counts = materialise(_word_counts(d.join(ids.alias("i"), same, "left_semi").select(
        "lang", "text")), "word_counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    pieces = public_pieces(path)
    longest = max(map(len, pieces))
    model = {lang: dict.fromkeys(pieces, 1 / len(pieces)) for lang in languages}
    for _ in range(EM_STEPS if languages else 0):
        found: dict[str, dict[bytes, float]] = defaultdict(dict)
        for lang, piece, n in _em_step(counts, model, longest).collect():  # vocabulary x languages
            found[lang][bytes(piece)] = n
        for lang in languages:
            total = sum(found[lang].values()) or 1.0
            model[lang] = {p: max(FLOOR, n / total) for p, n in found[lang].items()}
            for b in range(256):
                model[lang].setdefault(bytes([b]), FLOOR)
    kept = set().union(*model.values()) if languages else set()
    return Unigrams(languages, {p: tuple(model[x].get(p, FLOOR) for x in languages) for p in kept})


def identify(docs: DataFrame, model: Unigrams) -> DataFrame:
    """The input's columns and a struct ``language`` (lang_pred, score): the language with the
    largest probability and its posterior under equal priors. Ties go to the first name."""
    def score(batches):
        rows: dict[str, int] = {}
        logs = np.zeros((CACHE, len(model.languages)))

        def add(pending: list, total: np.ndarray) -> None:
            """Adds words, at most CACHE in all, to the totals of their texts."""
            new = set().union(*(some for _, some in pending)).difference(rows)
            if len(rows) + len(new) > CACHE:
                rows.clear()
                new = set().union(*(some for _, some in pending))
            new = list(new)
            first = len(rows)
            rows.update(zip(new, range(first, first + len(new))))
            logs[first:len(rows)] = model.words(new)
            for i, some in pending:
                total[i] += logs[np.fromiter(map(rows.__getitem__, some), np.int64, len(some))].sum(0)

        for texts in batches:
            total = np.zeros((len(texts), len(model.languages)))
            known, pending, held = np.zeros(len(texts), bool), [], 0
            for i, t in enumerate(texts.to_pylist() if model.languages else ()):
                ws = words_of(t) if t else []
                known[i] = bool(ws)
                for lo in range(0, len(ws), CACHE // 2):
                    some = ws[lo:lo + CACHE // 2]
                    if held + len(some) > CACHE:
                        add(pending, total)
                        pending, held = [], 0
                    pending.append((i, some))
                    held += len(some)
            if pending:
                add(pending, total)
            best = total.argmax(1) if model.languages else np.zeros(len(texts), int)
            top = total.max(1, initial=-np.inf)[:, None]
            share = 1 / np.exp(np.minimum(total - top, 0)).sum(1) if model.languages else np.zeros(len(texts))
            yield pa.StructArray.from_arrays(
                [pa.array([model.languages[j] if k else UNKNOWN for j, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, share, 0.0), pa.float64())], ["lang_pred", "score"])

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn("language", F.arrow_udf(score, "lang_pred string, score double")("text"))


def language_id(docs: DataFrame, path: str | None = None,
                per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score, one row per input row.

    Null texts and texts without a letter are ``und`` with score 0; so is everything when there
    is nothing to learn from. Rows with a null id are scored, never held out and never learned
    from. Repeated rows get equal results. Texts are read whole, lower-cased; words are runs of
    letters (Unicode categories L) with their marks (M), of any length, and never cut.
    """
    model = train(docs, path, per_language)
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "language.*")


def op8(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"))
