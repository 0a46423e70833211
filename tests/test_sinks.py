"""Writers: partition replace (idempotent, empty input, neighbours), by-name reordering,
overwrite modes, literal inserts, CSV round trip."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sigscore.operators import cook_signals
from sigscore.schemas import SCORED_SCHEMA
from sigscore.session import scratch_path, unique_name
from sigscore.sinks import tables as W
from sigscore.sources import fixtures as X

from conftest import SF_SMALL

D1, H1 = "2024-01-02", 5


def _cooked(spark):
    # Three days keep the partition count (and the test) small; semantics do not depend on it.
    raw = X.raw_signals(spark, SF_SMALL).where(F.col("date") < dt.date(2024, 1, 4))
    return cook_signals(raw, X.subtype_dim(spark))


def _table(spark, fmt="parquet", partitioned=True):
    name = unique_name("t_sink")
    W.create_table(spark, name, SCORED_SCHEMA, fmt, ("date", "hour") if partitioned else (),
                   scratch_path(spark, name))
    return name


def _counts(spark, name):
    return {(r["date"], r["hour"]): r["n"] for r in
            spark.table(name).groupBy("date", "hour").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_replace_partition_idempotent_and_isolated(spark, fmt):
    name = _table(spark, fmt)
    cooked = _cooked(spark)
    W.append(spark, cooked, name)
    before = _counts(spark, name)
    key = (dt.date.fromisoformat(D1), H1)
    assert before[key] > 0
    for _ in range(2):
        W.replace_partition(spark, cooked, name, D1, f"{H1:02d}")
    assert _counts(spark, name) == before


def test_replace_partition_empty_input_clears_only_that_partition(spark):
    name = _table(spark)
    cooked = _cooked(spark)
    W.append(spark, cooked, name)
    before = _counts(spark, name)
    W.replace_partition(spark, cooked.where(F.lit(False)), name, D1, H1)
    after = _counts(spark, name)
    key = (dt.date.fromisoformat(D1), H1)
    assert key not in after
    before.pop(key)
    assert after == before


def test_replace_partition_failed_write_keeps_old_rows(spark):
    name = _table(spark)
    cooked = _cooked(spark)
    W.append(spark, cooked, name)
    before = _counts(spark, name)
    boom = F.raise_error(F.lit("simulated failure")).cast("double")
    bad = cooked.withColumn("score", F.when(F.col("root_id") >= 0, boom))
    with pytest.raises(Exception):
        W.replace_partition(spark, bad, name, D1, H1)
    assert _counts(spark, name) == before


def test_replace_partition_returns_rows_written(spark):
    name = _table(spark)
    cooked = _cooked(spark)
    want = cooked.where((F.col("date") == dt.date.fromisoformat(D1))
                        & (F.col("hour") == H1)).count()
    assert W.replace_partition(spark, cooked, name, D1, H1) == want > 0
    assert W.replace_partition(spark, cooked.where(F.lit(False)), name, D1, H1) == 0


def test_replace_partition_ignores_other_hours_in_input(spark):
    name = _table(spark)
    W.replace_partition(spark, _cooked(spark), name, D1, H1)
    assert set(_counts(spark, name)) == {(dt.date.fromisoformat(D1), H1)}


def test_replace_partition_rejects_bad_arguments(spark):
    name = _table(spark)
    with pytest.raises(ValueError):
        W.replace_partition(spark, _cooked(spark), name, "2024-01-02' OR 1=1", 3)
    with pytest.raises(ValueError):
        W.replace_partition(spark, _cooked(spark), name, D1, 24)


def test_append_reorders_by_name(spark):
    name = _table(spark)
    cooked = _cooked(spark)
    shuffled = cooked.select(*reversed(cooked.columns))
    W.append(spark, shuffled, name)
    got = spark.table(name).orderBy("root_id", "meta_past_halflife").limit(5).collect()
    want = cooked.orderBy("root_id", "meta_past_halflife").limit(5).collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want]


def test_overwrite_missing_table_is_error(spark):
    with pytest.raises(AnalysisException):
        W.overwrite_rows(spark, _cooked(spark), unique_name("t_missing"))


def test_overwrite_modes(spark):
    name = _table(spark)
    cooked = _cooked(spark)
    W.append(spark, cooked, name)
    total = spark.table(name).count()
    one_hour = cooked.where((F.col("date") == dt.date.fromisoformat(D1)) & (F.col("hour") == H1))
    W.overwrite_rows(spark, one_hour, name, partition_mode="dynamic")
    assert spark.table(name).count() == total
    W.overwrite_rows(spark, one_hour, name, partition_mode="static")
    assert spark.table(name).count() == one_hour.count()


def test_insert_values_literal_row(spark):
    name = _table(spark)
    row = (11, 22, 33, 44, "00AA00BB00CC", "CUSTOMER",
           dt.datetime(2018, 1, 1, 2, 3, 4), dt.datetime(2018, 1, 1, 2, 8, 4), 2, None,
           100.0, 55)
    W.insert_values(spark, name, "2018-01-01", "02", [row])
    got = spark.table(name).collect()
    assert len(got) == 1
    assert got[0]["date"] == dt.date(2018, 1, 1) and got[0]["hour"] == 2
    assert got[0]["score"] == 100.0 and got[0]["trigger"] == "CUSTOMER"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv"])
def test_round_trip_formats_keep_microseconds(spark, fmt):
    name = _table(spark, fmt)
    cooked = _cooked(spark)
    W.append(spark, cooked, name)
    a = cooked.select("root_id", "ts_created", "ts_received", "score", "meta_past_halflife")
    b = spark.table(name).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_files_hold_no_partition_columns(spark):
    path = scratch_path(spark, "csvfiles")
    W.write_csv_files(_cooked(spark), path)
    first = spark.read.text(path).first()[0]
    assert len(first.split(",")) == len(SCORED_SCHEMA) - 2


def test_save_table_compression_and_partitions(spark):
    name = unique_name("t_gzip")
    path = scratch_path(spark, name)
    W.save_table(_cooked(spark), name, fmt="parquet", partition_by=("date", "hour"),
                 compression="gzip", path=path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .load(path).select("path").collect()
    assert any(".gz" in r[0] for r in files)
    assert spark.table(name).count() == _cooked(spark).count()


def test_write_settings_are_scoped(spark):
    keys = ("hive.exec.dynamic.partition.mode", "spark.sql.sources.partitionOverwriteMode")
    before = {k: spark.conf.get(k, None) for k in keys}
    name = _table(spark)
    W.append(spark, _cooked(spark), name)
    W.overwrite_rows(spark, _cooked(spark), name, partition_mode="static")
    W.replace_partition(spark, _cooked(spark), name, D1, H1)
    assert {k: spark.conf.get(k, None) for k in keys} == before
