"""Sources: generator, literal sample, CSV, JDBC option handling, schema description."""

import pytest
from pyspark.sql import functions as F

from sigscore.operators import add_null_column, add_product_column, filter_gt, select_two
from sigscore.operators.preview import describe_schema
from sigscore.schemas import SIMPLE_SCHEMA
from sigscore.session import scratch_path
from sigscore.sources import (frame_from_rows, generate_signals, jdbc_options,
                              scan_csv, scan_csv_strings)

from conftest import SF_SMALL

LOCAL_SAMPLE = ((7, 61, 9), (41, 52, 63), (3, 3, 3), (100, 0, 8), (5, 8, 13))


def test_generator_range_and_count(spark):
    df = generate_signals(spark, 5000, seed=3, num_partitions=4)
    stats = df.agg(*[F.min(c).alias(f"lo_{c}") for c in df.columns],
                   *[F.max(c).alias(f"hi_{c}") for c in df.columns],
                   F.count("*").alias("n")).first()
    assert stats["n"] == 5000
    for c in df.columns:
        assert stats[f"lo_{c}"] == 1 and stats[f"hi_{c}"] == 10
    assert df.collect() == df.collect()  # recomputation gives the same values


def test_generator_from_frame(spark):
    from sigscore.sources.fixtures import simple_signals
    base = simple_signals(spark, SF_SMALL)
    gen = generate_signals(spark, base, as_strings=True)
    assert gen.count() == base.count()
    assert dict(gen.dtypes) == {"x1": "string", "x2": "string", "x3": "string"}


def test_local_sample_walkthrough(spark):
    df = frame_from_rows(spark, LOCAL_SAMPLE, ["x1", "x2", "x3"])
    two = select_two(df)
    assert add_null_column(two).where(F.col("newCol").isNull()).count() == 5
    prod = {r.x1: r.newCol for r in add_product_column(two).collect()}
    assert prod[7] == 7 * 61
    kept = sorted(tuple(r) for r in filter_gt(two, "x2", 50).collect())
    assert kept == [(7, 61), (41, 52)]


def test_scan_csv_headerless(spark):
    path = scratch_path(spark, "csv_sample")
    frame_from_rows(spark, LOCAL_SAMPLE, SIMPLE_SCHEMA).write.csv(path)
    got = sorted(tuple(r) for r in scan_csv(spark, path).collect())
    assert got == sorted(LOCAL_SAMPLE)
    text = scan_csv_strings(spark, path)
    assert dict(text.dtypes) == {"x1": "string", "x2": "string", "x3": "string"}
    assert sorted(int(r.x1) for r in text.collect()) == sorted(r[0] for r in LOCAL_SAMPLE)


def test_jdbc_options():
    base = {"url": "jdbc:x://h/db", "dbtable": "s.t", "user": "u", "password": "p"}
    opts = jdbc_options(base)
    assert opts["dbtable"] == "s.t" and "partitionColumn" not in opts
    part = jdbc_options(base, "meta_past_id", 0, 100, 4)
    assert part["numPartitions"] == "4" and part["lowerBound"] == "0"
    with pytest.raises(ValueError):
        jdbc_options({"url": "jdbc:x://h/db"})
    with pytest.raises(ValueError):
        jdbc_options(base, "meta_past_id", 0)


def test_describe_schema(spark):
    df = frame_from_rows(spark, LOCAL_SAMPLE, SIMPLE_SCHEMA)
    rows = describe_schema(spark, df).collect()
    assert [(r.column_name, r.data_type) for r in rows] == [("x1", "int"), ("x2", "int"),
                                                            ("x3", "int")]


def test_csv_table_if_not_exists(spark):
    from sigscore.session import unique_name
    from sigscore.sources import create_csv_table
    path = scratch_path(spark, "csv_table")
    frame_from_rows(spark, LOCAL_SAMPLE, SIMPLE_SCHEMA).write.csv(path)
    name = unique_name("t_csv")
    create_csv_table(spark, name, SIMPLE_SCHEMA, path)
    create_csv_table(spark, name, SIMPLE_SCHEMA, path)  # second call is a no-op
    assert sorted(tuple(r) for r in spark.table(name).collect()) == sorted(LOCAL_SAMPLE)
    with pytest.raises(Exception):
        create_csv_table(spark, name, SIMPLE_SCHEMA, path, if_not_exists=False)
