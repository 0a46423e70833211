"""The per-subtype statistics of the flagship result at sf0.01 (FIXTURES.md, part B)."""

from pyspark.sql import functions as F

import __spark_entry__ as E

from conftest import SF_MID

# (meta_past_id, half-life): rows, non-null scores, distinct scores, min, max
EXPECTED = {
    (1, 24): (2006, 1977, 1868, -1.994034, -0.00036),
    (2, 48): (1982, 1941, 1827, -1.999993, 6.997731),
    (3, None): (1981, 1946, 1, 0.0, 0.0),
    (4, 12): (2017, 1967, 1, 0.0, 0.0),
    (4, 36): (2017, 1967, 1, 0.0, 0.0),
    (7, None): (2014, 1969, 1, 0.0, 0.0),
}


def test_flagship_statistics_sf001(spark):
    df = E.queries()["cook_signals"](spark, SF_MID)
    rows = (df.groupBy("meta_past_id", "meta_past_halflife")
            .agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("nn"),
                 F.countDistinct("score").alias("d"), F.min("score").alias("lo"),
                 F.max("score").alias("hi")).collect())
    got = {(r[0], r[1]): (r.n, r.nn, r.d, r.lo, r.hi) for r in rows}
    assert got == EXPECTED
    assert sum(v[0] for v in got.values()) == 12017


def test_entry_rows_sf0001(spark):
    assert E.entry(spark).count() == 1199


def test_row_count_is_sum_of_max_one_matches(spark):
    from collections import Counter

    from sigscore.operators import cook_signals, dim_current
    from sigscore.sources import fixtures as X
    from conftest import SF_SMALL
    raw = X.raw_signals(spark, SF_SMALL)
    dim = X.subtype_dim(spark)
    matches = Counter(r.meta_past_id for r in dim_current(dim).collect())
    per_id = {r[0]: r[1] for r in raw.groupBy("meta_past_id").count().collect()}
    expected = sum(n * max(1, matches.get(i, 0)) for i, n in per_id.items())
    assert cook_signals(raw, dim).count() == expected
    assert cook_signals(raw, dim, key_side="dim").count() == expected
