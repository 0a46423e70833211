"""The hourly job end to end: config resolution, argument checks, idempotent rerun."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sigscore.plans.job import JobConfig, config_for, run_hour
from sigscore.schemas import PARTITION_COLUMNS, SCORED_SCHEMA
from sigscore.session import scratch_path, unique_name
from sigscore.sinks import tables as W
from sigscore.sources import fixtures as X

from conftest import SF_SMALL


def test_config_for_environments():
    cfg = config_for("  dev\t", "dim_table")
    assert cfg.source_table.endswith("raw_signals") and cfg.target_table.startswith("dev.")
    assert config_for("na", "d").target_table == config_for("LOCAL", "d").target_table
    with pytest.raises(ValueError):
        config_for("prod", "d")
    with pytest.raises(ValueError):
        config_for(" ", "d")


@pytest.fixture()
def job(spark):
    raw = unique_name("t_jobraw")
    W.save_table(X.raw_signals(spark, SF_SMALL), raw, fmt="parquet",
                 partition_by=PARTITION_COLUMNS, path=scratch_path(spark, raw))
    dim = unique_name("t_dim")
    W.save_table(X.subtype_dim(spark), dim, fmt="parquet", path=scratch_path(spark, dim))
    target = unique_name("t_target")
    W.create_table(spark, target, SCORED_SCHEMA, "parquet", PARTITION_COLUMNS,
                   scratch_path(spark, target))
    return JobConfig(source_table=raw, target_table=target, dimension=dim)


def test_run_hour_twice_is_idempotent(spark, job):
    out1 = run_hour(spark, job, "2024-01-03", "07", "NA").count()
    out2 = run_hour(spark, job, "2024-01-03", "07", "NA").count()
    raw_rows = X.raw_signals(spark, SF_SMALL, "2024-01-03", 7)
    fan = raw_rows.where(F.col("meta_past_id") == 4).count()
    assert out1 == out2 == raw_rows.count() + fan
    assert spark.table(job.target_table).count() == out1


def test_run_hour_empty_hour_clears_partition(spark, job):
    W.insert_values(spark, job.target_table, "2030-01-01", 0,
                    [(1, 1, 1, 1, "m", "T", dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 1),
                      1, 24, 0.0, 1)])
    assert run_hour(spark, job, "2030-01-01", 0).count() == 0
    assert spark.table(job.target_table).count() == 0


def test_run_hour_blank_arguments(spark, job):
    with pytest.raises(ValueError):
        run_hour(spark, job, "2024-01-03", "07", " ")
    with pytest.raises(ValueError):
        run_hour(spark, job, " ", "07")


def test_run_hour_dim_key_side(spark, job):
    from dataclasses import replace
    cfg = replace(job, key_side="dim")
    out = run_hour(spark, cfg, "2024-01-03", 7)
    ids = {r[0] for r in out.select("meta_past_id").distinct().collect()}
    assert ids <= {1, 2, 4, None}


def test_cluster_defaults_never_override(spark):
    from sigscore.session import apply_cluster_defaults
    applied = apply_cluster_defaults(spark, {"spark.sql.shuffle.partitions": "999",
                                             "spark.sigscore.test.unset": "x"})
    try:
        assert applied == {"spark.sigscore.test.unset": "x"}
        assert spark.conf.get("spark.sql.shuffle.partitions") != "999"
    finally:
        spark.conf.unset("spark.sigscore.test.unset")


def test_schema_contracts(spark):
    from sigscore.operators import cook_signals
    from sigscore.schemas import RAW_SCHEMA, SCORED_SCHEMA, check_schema
    raw = X.raw_signals(spark, SF_SMALL)
    check_schema(raw.schema, RAW_SCHEMA)
    cooked = cook_signals(raw, X.subtype_dim(spark))
    check_schema(cooked.schema, SCORED_SCHEMA)
    assert tuple(cooked.columns) == tuple(SCORED_SCHEMA.fieldNames())
    with pytest.raises(ValueError, match="missing technical_value"):
        check_schema(raw.drop("technical_value").schema, RAW_SCHEMA)
    with pytest.raises(ValueError, match="meta_past_id: int"):
        check_schema(raw.withColumn("meta_past_id", F.col("meta_past_id").cast("int")).schema,
                     RAW_SCHEMA)


def test_run_hour_rejects_wrong_source_schema(spark, job):
    from dataclasses import replace
    bad = replace(job, source_reader=lambda s, d, h: X.raw_signals(s, SF_SMALL, d, h)
                  .drop("cust_relevance"))
    with pytest.raises(ValueError, match="cust_relevance"):
        run_hour(spark, bad, "2024-01-03", 7)


def test_cli_main_end_to_end(spark):
    from sigscore.plans.job import main
    from sigscore.session import CLUSTER_DEFAULTS
    unset_before = [k for k in CLUSTER_DEFAULTS if spark.conf.get(k, None) is None]
    W.save_table(X.raw_signals(spark, SF_SMALL), "raw_signals", fmt="parquet",
                 partition_by=PARTITION_COLUMNS, path=scratch_path(spark, "cli_raw"))
    W.create_table(spark, "scored_signals", SCORED_SCHEMA, "parquet", PARTITION_COLUMNS,
                   scratch_path(spark, "cli_scored"))
    dim = unique_name("t_cli_dim")
    W.save_table(X.subtype_dim(spark), dim, fmt="parquet", path=scratch_path(spark, dim))
    try:
        import contextlib
        import io
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            assert main(["2024-01-03", "07", "na", "NA", "--dimension-table", dim,
                         "--explain"]) == 0
        assert "BroadcastHashJoin" in out.getvalue() and "PartitionFilters" in out.getvalue()
        assert spark.table("scored_signals").count() == 0  # explain writes nothing
        assert main(["2024-01-03", "07", " local ", "NA", "--dimension-table", dim]) == 0
        got = spark.table("scored_signals")
        raw_rows = X.raw_signals(spark, SF_SMALL, "2024-01-03", 7)
        fan = raw_rows.where(F.col("meta_past_id") == 4).count()
        assert got.count() == raw_rows.count() + fan
        assert {(r.date, r.hour) for r in got.select("date", "hour").distinct().collect()} == \
            {(dt.date(2024, 1, 3), 7)}
    finally:
        for key in unset_before:
            spark.conf.unset(key)
        spark.sql("DROP TABLE IF EXISTS raw_signals")
        spark.sql("DROP TABLE IF EXISTS scored_signals")
