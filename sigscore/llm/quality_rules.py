"""Quality rules by weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at one measure of a text and votes good, bad or nothing. The rules' accuracies
and the share of good documents are estimated from the votes alone by expectation-maximisation
over the table of vote patterns, and a document is kept when the posterior probability of being
good is high enough. No rule can reject a document by itself; only the fixed base rules do.

Everything that touches documents is a DataFrame expression. The documents are read once; the
table of vote patterns has at most 3 ** len(rules()) rows whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import SPACE_CLASS, materialise, table, without_spaces, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_POSTERIOR = 0.5
EM_STEPS = 30
PRIOR_GOOD = 0.85
START_ON_GOOD, START_ON_BAD = 0.98, 0.4
SMOOTH = 2.0  # pseudo-votes of each rate, half of them right, and as many pseudo-documents

ALL = 2**30  # as the length of a slice: to the end

LETTER = r"[A-Za-z\x{80}-\x{10FFFF}]"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with_windows(rows: DataFrame) -> DataFrame:
    """Adds ``win``, the hashes of all windows of 8 of the words ``w``, by doubling: pairs,
    fours, eights. A text whose fours all differ repeats no window; its eights are left out
    (null). Each step is a projection of its own, so that none is computed twice."""
    for of, step in (("w", 1), ("win", 2)):
        rows = rows.withColumn("win", F.zip_with(
            of, F.slice(of, step + 1, ALL), lambda a, b: F.xxhash64(a, b)))
    eights = F.zip_with("win", F.slice("win", 5, ALL), lambda a, b: F.xxhash64(a, b))
    return rows.withColumn("win", F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.slice(eights, 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(0)))))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words, the words in windows that occur twice or more. The few texts with
    such a window have their windows sorted by hash; equal neighbours give the places, and each
    place adds the words up to the next place, 8 at most."""
    at = F.when(F.size(F.array_distinct("win")) < F.size("win"),
                F.zip_with("win", F.sequence(F.lit(1), F.size("win")),
                           lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    nil = F.array(F.lit(None).cast("struct<h:bigint,p:int>"))
    rows = rows.withColumn("at", F.sort_array(at))
    rows = rows.withColumn("same", F.zip_with(
        "at", F.slice("at", 2, ALL), lambda a, b: a["h"] == b["h"]))  # as the next one
    rows = rows.withColumn("places", F.sort_array(F.array_compact(F.zip_with(
        F.zip_with("at", "same", lambda a, s: F.when(s, a["p"])),
        F.zip_with("at", F.concat(F.array(F.lit(False)), "same"),
                   lambda a, s: F.when(s, a["p"])),
        lambda x, y: F.coalesce(x, y)))))
    steps = F.zip_with("places", F.slice("places", 2, ALL), lambda p, q: F.least(
        F.lit(WINDOW), F.coalesce(q - p, F.lit(WINDOW))))
    return rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(
        steps, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long")))


def base_measures(docs: DataFrame) -> DataFrame:
    """doc_id with the base counts and a few more measures. One pass over whole texts, no
    shuffle. Null and blank texts have no words and zero counts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    # the shape of a text: each run of letters is one a, all else stays
    rows = rows.select("doc_id", "t", words(F.col("t")).alias("w"), lines.alias("lines"),
                       F.regexp_replace("t", f"{LETTER}+", "a").alias("shape"))

    def left(text: str, pattern: str) -> Column:
        """Characters that are left when the pattern is taken out."""
        return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")

    counts = rows.select(
        "doc_id", "w",
        F.size("w").cast("long").alias("n_words"),
        (F.char_length("t") - F.char_length("shape") + F.char_length(
            without_spaces(F.col("shape")))).cast("long").alias("word_chars"),
        left("shape", "[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        left("t", "[^A-Z]+").alias("n_upper"),
        left("shape", "[^!?]+").alias("n_marks"),
        left("shape", f"[a{SPACE_CLASS}]+").alias("n_other"))
    return _with_repeats(_with_windows(counts)).drop("w", "win", "at", "same", "places")


def _vote(bad: Column, good: Column) -> Column:
    """-1 for bad, 1 for good, 0 to abstain; a missing measure abstains."""
    return F.coalesce(F.when(bad, -1).when(good, 1), F.lit(0)).cast("tinyint")


def rules() -> dict[str, Column]:
    """The voting rules over the measures. Ratios of an empty text are null: it abstains."""
    chars = F.nullif(F.col("word_chars"), F.lit(0))
    n = F.nullif(F.col("n_words"), F.lit(0))
    lines = F.nullif(F.col("n_lines"), F.lit(0))
    mean = F.col("word_chars") / n

    def share(part: str, of: Column, bad: float, good: float) -> Column:
        return _vote(F.col(part) / of > bad, F.col(part) / of < good)

    return {
        "symbols": share("n_symbols", chars, 0.08, 0.02),
        "other_chars": share("n_other", chars, 0.25, 0.12),
        "symbol_words": share("n_symbols", n, 0.4, 0.1),
        "dup_lines": share("n_dup_lines", lines, 0.3, 0.1),
        "repeats": share("n_repeat_words", n, 0.2, 0.05),
        "upper": share("n_upper", chars, 0.5, 0.2),
        "marks": share("n_marks", n, 0.3, 0.1),
        "word_length": _vote((mean < 2) | (mean > 20), (mean >= 3) & (mean <= 12)),
    }


class Accuracies:
    """What EM estimates: the share of good documents, and for each rule how often it is right
    on good and on bad documents when it votes."""

    def __init__(self, names, prior=PRIOR_GOOD, on_good=START_ON_GOOD, on_bad=START_ON_BAD):
        self.prior = prior
        self.on_good = dict.fromkeys(names, on_good)
        self.on_bad = dict.fromkeys(names, on_bad)


    def log_ratios(self) -> tuple[float, dict[str, tuple[float, float]]]:
        """The prior's log odds, and for each rule the log ratio of a good and of a bad vote's
        probabilities on good and on bad documents."""
        return math.log(self.prior / (1 - self.prior)), {
            r: (math.log(g / (1 - self.on_bad[r])), math.log((1 - g) / self.on_bad[r]))
            for r, g in self.on_good.items()}


def posterior(acc: Accuracies) -> Column:
    """Probability of a good document given its votes: the prior's log odds, plus for each vote
    its log ratio. An abstention adds nothing."""
    prior, ratios = acc.log_ratios()
    odds = F.lit(prior)
    for r, (good_vote, bad_vote) in ratios.items():
        odds = odds + F.when(F.col(r) > 0, good_vote).when(F.col(r) < 0, bad_vote).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate_accuracies(patterns: list, names: list[str], steps: int = EM_STEPS) -> Accuracies:
    """EM for rules that vote independently given the class.

    ``patterns`` holds a row per vote pattern with its count ``n``. The counts come from one
    distributed aggregation over all documents and have at most 3 ** len(names) rows whatever
    the input, so the steps are plain arithmetic on the driver.

    The start says that most documents are good and that a bad vote on a good document is rare.
    Nothing else holds a rate but ``SMOOTH`` pseudo-votes, so a rule that knows nothing comes out
    near one half on both classes and its votes weigh nothing. The classes are named at the end:
    good is the one with fewer bad votes, over all rules.
    """
    acc = Accuracies(names)

    def rate(weights, r, sign):
        voted = [(w, row[r]) for w, row in zip(weights, patterns) if row[r]]
        right = sum(w for w, vote in voted if vote * sign > 0)
        return (right + SMOOTH / 2) / (sum(w for w, _ in voted) + SMOOTH)

    for _ in range(steps if patterns else 0):
        prior, ratios = acc.log_ratios()
        good, bad = [], []
        for row in patterns:
            odds = prior + sum(ratios[r][row[r] < 0] for r in names if row[r])
            p = 1 / (1 + math.exp(-odds))
            good.append(row["n"] * p)
            bad.append(row["n"] * (1 - p))
        acc.prior = (sum(good) + SMOOTH / 2) / (sum(good) + sum(bad) + SMOOTH)
        for r in names:
            acc.on_good[r] = rate(good, r, 1)
            acc.on_bad[r] = rate(bad, r, -1)
    if sum(1 - acc.on_good[r] - acc.on_bad[r] for r in names) > 0:
        acc.prior = 1 - acc.prior
        acc.on_good, acc.on_bad = ({r: 1 - acc.on_bad[r] for r in names},
                                   {r: 1 - acc.on_good[r] for r in names})
    return acc


def quality_rules(docs: DataFrame, keep_posterior: float = KEEP_POSTERIOR) -> DataFrame:
    """Per document: the base counts, the votes (``vote_<rule>``), ``base_failed``, the
    ``posterior`` of being good and ``kept``.

    Null, empty and blank texts count zero words, abstain everywhere and fail the base rule.
    Repeated rows and null ids are judged like any other row, one output row each. An empty
    table gives an empty result. Only ``doc_id`` and ``text`` of the input are read.
    """
    votes = rules()
    names = [f"vote_{r}" for r in votes]
    measured = materialise(
        base_measures(docs).select("*", *[v.alias(f"vote_{r}") for r, v in votes.items()]),
        "quality_measures")
    patterns = measured.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    acc = estimate_accuracies(patterns, names)
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return measured.withColumn("base_failed", failed).withColumn(
        "posterior", posterior(acc)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep_posterior))


def op2(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", *BASE, "base_failed", "kept", "posterior")
