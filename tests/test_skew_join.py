"""The join beyond the broadcast budget: equal to the plain join, and balanced under skew."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigscore.operators.sizing import lookup_join

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=8, deadline=None)
@given(fact_keys=st.lists(keys, min_size=1, max_size=120), how=st.sampled_from(["left", "inner"]),
       hot=st.integers(min_value=0, max_value=6), hot_share=st.integers(0, 200),
       dim=st.lists(st.tuples(keys, st.integers(0, 99)), max_size=12))
def test_shuffle_join_equals_plain(spark, fact_keys, how, hot, hot_share, dim):
    fact = spark.createDataFrame(list(enumerate(fact_keys + [hot] * hot_share)), "id long, k long")
    d = spark.createDataFrame(dim, "dk long, v long")
    joined = lookup_join(fact, d, "k", "dk", how, broadcast_max_bytes=-1)
    plain = fact.join(d, fact["k"] == d["dk"], how)
    cols = ("id", "k", "dk", "v")
    assert _rows(joined.select(*cols)) == _rows(plain.select(*cols))


SMALL = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
         "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.mark.parametrize("key", ["CASE WHEN id % 2 = 0 THEN 7 ELSE id END",
                                 "CASE WHEN id % 10 < 7 THEN NULL ELSE id END",
                                 "id % 3"])
def test_no_join_task_gets_a_whole_hot_key(spark, key):
    """One key with half of the rows, 70 % NULL keys, three keys with all rows: rows per join
    task, counted by the task that put them out."""
    before = {k: spark.conf.get(k) for k in SMALL}
    try:
        for k, v in SMALL.items():
            spark.conf.set(k, v)
        n = 100_000
        fact = spark.range(0, n, 1, 32).selectExpr("id", f"{key} AS k",
                                                   "sha2(string(id), 512) AS payload")
        dim = spark.range(0, 1000).selectExpr("id AS dk", "id * 2 AS v")
        joined = lookup_join(fact, dim, "k", "dk", broadcast_max_bytes=0)
        tasks = joined.select("payload", F.spark_partition_id().alias("t")).groupBy("t").agg(
            F.count("*").alias("n"), F.max("payload")).collect()  # the payload is not pruned
        assert sum(r["n"] for r in tasks) == n
        assert max(r["n"] for r in tasks) < n / 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
