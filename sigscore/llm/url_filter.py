"""URL filter: host rules first, gradient-boosted trees for the rest.

The rules label the urls they fit. Trees boosted on lexical features of those urls (lengths,
depth, digits, entropy, parameters, statistics of the host's suffix) judge the urls that no rule
fits. Features are DataFrame expressions and the trees are those of ``pyspark.ml``, all in the
JVM.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigscore.llm._common import fresh, materialise, table

# rule (host, path): verdict. Fixed by the query's contract.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block",
         "org/fr/": "allow"}
MAX_TRAIN_URLS = 20_000  # bound of the labelled sample that the trees are fitted on
TREES, DEPTH, STEP = 10, 4, 0.3
DEFAULT_VERDICT = "allow"  # where there is no labelled url to learn from
SUFFIX_PRIOR = 10.0        # pseudo-observations that pull a rare suffix to the overall rate
SEED = 5

FEATURES = ("url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio",
            "host_digits", "hyphens", "entropy", "params", "specials", "suffix_rate",
            "suffix_count")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path starts the
    url's; null when none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        cut = rule.index("/")
        rule_host, rule_path = rule[:cut], rule[cut:]
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters, in bits; 0 for an empty text."""
    n = F.char_length(text).cast("double")
    share = lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n
    bits = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                       lambda s, c: F.when(c == "", s).otherwise(s - share(c) * F.log2(share(c))))
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def _letters_out(text: Column, pattern: str) -> Column:
    """How many characters of a text are not matched by a pattern of runs."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features to (url, host, path)."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.char_length(url).cast("double")
    return urls.select(
        "*", n.alias("url_length"),
        F.char_length("host").cast("double").alias("host_length"),
        F.char_length("path").cast("double").alias("path_length"),
        _letters_out(F.col("path"), "[^/]+").alias("depth"),
        F.size(F.split("host", r"\.")).cast("double").alias("host_labels"),
        F.when(n > 0, _letters_out(url, "[^0-9]+") / n).otherwise(0.0).alias("digit_ratio"),
        _letters_out(F.col("host"), "[^0-9]+").alias("host_digits"),
        _letters_out(url, "[^-]+").alias("hyphens"),
        _entropy(url).alias("entropy"),
        _letters_out(url, "[^=]+").alias("params"),
        _letters_out(url, "[^%&@~_+]+").alias("specials"),
        F.substring_index("host", ".", -1).alias("suffix"))


def _with_suffix_statistics(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """Adds the share of blocked urls and the count of labelled urls per suffix, counted over
    all labelled urls. The counts are pre-aggregated before the shuffle; the join is left to the
    planner, which knows the size of the written statistics."""
    overall = labelled.agg(F.avg("label")).first()[0]
    overall = 0.5 if overall is None else overall
    stats = materialise(labelled.groupBy(F.col("suffix").alias("s")).agg(
        F.count("*").cast("double").alias("n"), F.sum("label").alias("blocked")), "suffixes")
    joined = urls.join(stats, F.col("suffix") == F.col("s"), "left")
    n = F.coalesce("n", F.lit(0.0))
    rate = (F.coalesce("blocked", F.lit(0.0)) + SUFFIX_PRIOR * overall) / (n + SUFFIX_PRIOR)
    return joined.withColumn("suffix_rate", rate).withColumn("suffix_count", F.log1p(n)).drop(
        "s", "n", "blocked")


def judge_urls(pages: DataFrame, rules: dict[str, str] | None = None,
               max_train: int = MAX_TRAIN_URLS) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, and block_probability (null
    where a rule decides).

    Null urls and urls without ``://`` have an empty host and path, fit no rule and are judged by
    the trees on their features. Repeated rows and null ids are judged like any other. Without
    labelled urls every verdict is DEFAULT_VERDICT; with labels of one kind it is that kind. An
    empty table gives an empty result. Only ``page_id`` and ``url`` are read.

    The trees are fitted on at most ``max_train`` labelled urls, those with the smallest hashes;
    suffix statistics are counted over all labelled urls.
    """
    rules = RULES if rules is None else rules
    urls = pages.select("page_id", "url").withColumn("host", host_of(F.col("url"))).withColumn(
        "path", path_of(F.col("url")))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    label = F.lit(None).cast("double")
    for name, verdict in rules.items():
        label = F.when(F.col("rule") == name, 1.0 if verdict == "block" else 0.0).otherwise(label)
    urls = lexical(urls.withColumn("rule", rule).withColumn("label", label))
    urls = materialise(urls, "url_features")
    labelled = urls.where(F.col("label").isNotNull())
    kinds = [r["label"] for r in labelled.select("label").distinct().collect()]  # two at most
    by_rule = F.when(F.col("label") == 1, "block").when(F.col("label") == 0, "allow")
    columns = ["page_id", "host", "path", "rule"]
    if len(kinds) < 2:
        only = DEFAULT_VERDICT if not kinds else ("block" if kinds[0] == 1 else "allow")
        return urls.select(*columns, F.coalesce(by_rule, F.lit(only)).alias("verdict"),
                           F.lit(None).cast("double").alias("block_probability"))
    urls = _with_suffix_statistics(urls, labelled)
    vector, raw, probability, predicted = (fresh(x) for x in ("v", "raw", "p", "y"))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol=vector)
    sample = urls.where(F.col("label").isNotNull()).orderBy(
        F.xxhash64(F.lit(SEED), "url", "page_id"), "page_id").limit(max_train)
    sample = materialise(assemble.transform(sample).select("label", vector), "url_sample")
    boosting = GBTClassifier(featuresCol=vector, labelCol="label", predictionCol=predicted,
                             maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED)
    trees = boosting.setRawPredictionCol(raw).setProbabilityCol(probability).fit(sample)
    judged = trees.transform(assemble.transform(urls))
    p = vector_to_array(F.col(probability))[1]
    by_trees = F.when(p >= 0.5, "block").otherwise("allow")
    return judged.select(*columns, F.coalesce(by_rule, by_trees).alias("verdict"),
                         F.when(F.col("label").isNull(), p).alias("block_probability"))


def op9(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"))
