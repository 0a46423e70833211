"""Registered queries: one per inventory operator, each with its DuckDB oracle where SQL can
say the same thing.

Every query reads the driver's tables (or data Spark derives from them) in full. Writers write
to fresh, uniquely named tables under the session's shared scratch folder and return the table
read back. Scores are rounded to 6 places on both sides (libm last-bit differences).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigscore import oracle_sql as O
from sigscore.functions.curves import add_ten, hfc, speedtest
from sigscore.functions.text import is_blank, normalise_text
from sigscore.operators import (add_null_column, add_product_column, cook_signals,
                                count_rows, dim_duplicate_keys, filter_gt, join_inner_alias,
                                lookup_halflife, preview_cooked, preview_rows, score_signals,
                                score_signals_text_ts, score_simple, select_score_inputs,
                                select_two, with_score_by_subtype)
from sigscore.plans.job import JobConfig, run_hour
from sigscore.schemas import (PARTITION_COLUMNS, SCORED_SCHEMA, SIMPLE_SCHEMA,
                              SIMPLE_STRING_SCHEMA)
from sigscore.session import scratch_path, unique_name
from sigscore.sinks import tables as W
from sigscore.sources import fixtures as X
from sigscore.sources.delimited import (create_csv_table, load_csv_into_table, load_csv_partition,
                                        load_csv_quarantine, read_quarantine, scan_csv)
from sigscore.sources.jdbc import read_dimension
from sigscore.sources.tables import scan_partition, scan_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The hour used by the single-partition queries.
PART_DATE, PART_HOUR = "2024-01-12", 16
PART_WHERE = f"s.\"date\" = DATE '{PART_DATE}' AND s.\"hour\" = {PART_HOUR}"


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ----------------------------------------------------------------------------- helpers
def _raw(spark, sf) -> DataFrame:
    return X.raw_signals(spark, sf)


def _dim(spark) -> DataFrame:
    return read_dimension(spark, X.subtype_dim(spark))


def _cooked(spark, sf, key_side="fact") -> DataFrame:
    return cook_signals(_raw(spark, sf), _dim(spark), key_side)


def _round_score(df: DataFrame, col: str = "score") -> DataFrame:
    return df.withColumn(col, F.round(col, 6))


def _readback(spark, name) -> DataFrame:
    return _round_score(W.read_table(spark, name).select(*SCORED_SCHEMA.fieldNames()))


def _scored_table(spark, prefix, fmt="parquet", partitioned=True, compression=None) -> str:
    name = unique_name(prefix)
    W.create_table(spark, name, SCORED_SCHEMA, fmt,
                   PARTITION_COLUMNS if partitioned else (), scratch_path(spark, name),
                   compression)
    return name


COOK = O.cook_sql()


# ----------------------------------------------------------------------------- scans
@register("scan_partition", O.with_ctes(
    f"SELECT * FROM raw_signals s WHERE {PART_WHERE}"))
def q_scan_partition(spark, sf):
    return scan_partition(spark, X.raw_signals(spark, sf, PART_DATE, PART_HOUR),
                          PART_DATE, PART_HOUR)


@register("scan_table", O.with_ctes("SELECT * FROM raw_signals"))
def q_scan_table(spark, sf):
    return scan_table(spark, _raw(spark, sf))


@register("scan_csv", O.with_ctes("SELECT * FROM simple_signals"))
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "simple_csv")
    X.simple_signals(spark, sf).write.option("header", "false").csv(path)
    return scan_csv(spark, path, SIMPLE_SCHEMA)


@register("scan_csv_strings", O.with_ctes("SELECT * FROM simple_strings"))
def q_scan_csv_strings(spark, sf):
    """Headerless CSV files under an external all-STRING table (``CREATE TABLE … USING csv``)."""
    path = scratch_path(spark, "simple_csv_str")
    X.simple_signals(spark, sf, as_strings=True).write.option("header", "false").csv(path)
    name = create_csv_table(spark, unique_name("sig_csv_str"), SIMPLE_STRING_SCHEMA, path)
    return spark.table(name)


@register("load_csv_into_table", O.with_ctes("SELECT * FROM simple_signals"))
def q_load_csv_into_table(spark, sf):
    path = scratch_path(spark, "simple_load")
    X.simple_signals(spark, sf).write.option("header", "false").csv(path)
    name = unique_name("sig_simple")
    W.create_table(spark, name, SIMPLE_SCHEMA, "parquet", (), scratch_path(spark, name))
    load_csv_into_table(spark, path, name)
    return spark.table(name)


@register("load_csv_quarantine", O.with_ctes(
    "SELECT x1, x2, x3, CAST(NULL AS VARCHAR) AS raw FROM simple_signals WHERE x1 % 7 <> 0 "
    "UNION ALL SELECT NULL, NULL, NULL, CASE WHEN x1 % 2 = 0 THEN concat(x1, ',', x2) "
    "ELSE concat(x1, ',', x2, ',', x3, ',surplus') END FROM simple_signals WHERE x1 % 7 = 0"))
def q_load_csv_quarantine(spark, sf):
    """A folder in which some records have a field too few or too many: the table gets the good
    ones, the others' raw text is kept beside it."""
    path, aside = scratch_path(spark, "simple_mixed"), scratch_path(spark, "quarantine")
    x1, line = F.col("x1"), F.concat_ws(",", "x1", "x2", "x3")
    X.simple_signals(spark, sf).select(
        F.when(x1 % 7 != 0, line).when(x1 % 2 == 0, F.concat_ws(",", "x1", "x2"))
        .otherwise(F.concat(line, F.lit(",surplus")))).write.text(path)
    name = unique_name("sig_simple")
    W.create_table(spark, name, SIMPLE_SCHEMA, "parquet", (), scratch_path(spark, name))
    load_csv_quarantine(spark, path, name, aside)
    good = spark.table(name).withColumn("raw", F.lit(None).cast("string"))
    bad = read_quarantine(spark, SIMPLE_SCHEMA, aside).select(
        *[F.lit(None).cast("int").alias(c) for c in ("x1", "x2", "x3")],
        F.col("_corrupt_record").alias("raw"))
    return good.unionByName(bad)


@register("select_score_inputs", O.with_ctes(
    "SELECT meta_past_id, technical_value, cust_relevance FROM raw_signals"))
def q_select_score_inputs(spark, sf):
    return select_score_inputs(_raw(spark, sf))


@register("score_signals", O.with_ctes(
    'SELECT party_id, building_port_id, cpe_equipment_id, cpe_port_id, cpe_mac, "trigger", '
    "ts_created, ts_received, meta_past_id, round(score, 6) AS score, root_id, \"date\", "
    '"hour" FROM scored'))
def q_score_signals(spark, sf):
    return _round_score(score_signals(_raw(spark, sf)))


@register("score_signals_text_ts", O.with_ctes(
    'SELECT party_id, building_port_id, cpe_equipment_id, cpe_port_id, cpe_mac, "trigger", '
    "CAST(ts_created AS VARCHAR) AS ts_created, CAST(ts_received AS VARCHAR) AS ts_received, "
    'meta_past_id, round(score, 6) AS score, root_id, "date", "hour" FROM scored'))
def q_score_signals_text_ts(spark, sf):
    return _round_score(score_signals_text_ts(_raw(spark, sf)))


@register("score_speedtest", O.with_ctes(
    "SELECT root_id, round("
    + O.speedtest_sql("(technical_value * cust_relevance)") + ", 6) AS score FROM raw_signals"))
def q_score_speedtest(spark, sf):
    raw = _raw(spark, sf)
    return raw.select("root_id", F.round(speedtest(F.col("technical_value")
                                                   * F.col("cust_relevance")), 6).alias("score"))


@register("score_hfc", O.with_ctes(
    "SELECT root_id, round(" + O.hfc_sql("(technical_value * cust_relevance)")
    + ", 6) AS score FROM raw_signals"))
def q_score_hfc(spark, sf):
    raw = _raw(spark, sf)
    return raw.select("root_id", F.round(hfc(F.col("technical_value")
                                             * F.col("cust_relevance")), 6).alias("score"))


# A caller's own curve for subtype 3, vectorised with pandas (Arrow batches): 5*tanh(x/100).
@F.pandas_udf(T.DoubleType())
def saturating_curve(x: pd.Series) -> pd.Series:
    import numpy as np
    return 5.0 * np.tanh(x / 100.0)


def _saturating_sql(x: str) -> str:
    return f"({O.d(5.0)} * tanh({x} / {O.d(100.0)}))"


CUSTOM_CURVES_SQL = {**O.DEFAULT_CURVES_SQL, 3: _saturating_sql}


@register("score_custom_curve", O.with_ctes(
    "SELECT root_id, meta_past_id, round(" + O.score_sql(curves=CUSTOM_CURVES_SQL)
    + ", 6) AS score FROM raw_signals"))
def q_score_custom_curve(spark, sf):
    from sigscore.functions.curves import DEFAULT_CURVES, score_expr
    curves = {**DEFAULT_CURVES, 3: saturating_curve}
    raw = _raw(spark, sf)
    return raw.select("root_id", "meta_past_id",
                      F.round(score_expr(curves=curves), 6).alias("score"))


@register("score_custom_curve_split", O.with_ctes(
    "SELECT root_id, meta_past_id, round(" + O.score_sql(curves=CUSTOM_CURVES_SQL)
    + ", 6) AS score FROM raw_signals"))
def q_score_custom_curve_split(spark, sf):
    scored = with_score_by_subtype(_raw(spark, sf), {3: saturating_curve})
    return scored.select("root_id", "meta_past_id", F.round("score", 6).alias("score"))


@register("cook_signals", COOK)
def q_cook_signals(spark, sf):
    return _round_score(_cooked(spark, sf))


@register("cook_signals_dim_key", O.cook_sql(key="c.dim_key"))
def q_cook_signals_dim_key(spark, sf):
    return _round_score(_cooked(spark, sf, key_side="dim"))


def _wide(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Facts with a dominant key, NULL keys and a tail, and a dimension of a row per customer."""
    root = F.col("root_id")
    key = F.when(root % 3 == 0, 2).when(root % 7 == 0, None).otherwise(root % 997 + 1)
    c = spark.read.parquet(f"{str(sf).rstrip('/')}/customer.parquet")
    dim = c.select(F.col("c_custkey").cast("long").alias("meta_past_id"),
                   F.col("c_nationkey").cast("long").alias("meta_pat_id"),
                   (F.col("c_custkey") % 89).cast("long").alias("meta_past_halflife"),
                   F.when(F.col("c_custkey") % 5 == 0, 0).otherwise(1).alias("scd_is_active"),
                   F.when(F.col("c_custkey") % 11 == 0, 1).otherwise(0).alias("scd_is_deleted"))
    return _raw(spark, sf).withColumn("meta_past_id", key.cast("long")), dim


@register("cook_signals_shuffle", O.COOK_WIDE_SQL)
def q_cook_signals_shuffle(spark, sf):
    """The job's join beyond the broadcast budget, forced here by a budget of nothing."""
    raw, dim = _wide(spark, sf)
    return _round_score(cook_signals(raw, dim, broadcast_max_bytes=0))


@register("join_inner_alias_shuffle", O.WIDE_CTES + """
SELECT s.root_id, s.meta_past_id AS l_meta_past_id, c.meta_past_id AS r_meta_past_id,
       c.meta_past_halflife
FROM raw_signals s JOIN subtype_dim c ON s.meta_past_id = c.meta_past_id""")
def q_join_inner_alias_shuffle(spark, sf):
    raw, dim = _wide(spark, sf)
    return join_inner_alias(raw.select("root_id", "meta_past_id"),
                            dim.select("meta_past_id", "meta_past_halflife"),
                            broadcast_max_bytes=0)


@register("select_two", O.with_ctes("SELECT x1, x2 FROM simple_signals"))
def q_select_two(spark, sf):
    return select_two(X.simple_signals(spark, sf))


@register("add_null_column", O.with_ctes(
    'SELECT x1, x2, CAST(NULL AS INTEGER) AS "newCol" FROM simple_signals'))
def q_add_null_column(spark, sf):
    return add_null_column(select_two(X.simple_signals(spark, sf)), "newCol", "int")


@register("add_product_column", O.with_ctes(
    'SELECT x1, x2, x1 * x2 AS "newCol" FROM simple_signals'))
def q_add_product_column(spark, sf):
    return add_product_column(select_two(X.simple_signals(spark, sf)), "newCol")


@register("filter_gt", O.with_ctes("SELECT x1, x2 FROM simple_signals WHERE x1 > 40"))
def q_filter_gt(spark, sf):
    return filter_gt(select_two(X.simple_signals(spark, sf)), "x1", 40)


@register("score_simple", O.with_ctes(
    "SELECT x1, round(" + O.speedtest_sql("TRY_CAST(x1 AS DOUBLE)") + ", 6) AS y "
    "FROM simple_strings"))
def q_score_simple(spark, sf):
    return _round_score(score_simple(X.simple_signals(spark, sf, as_strings=True)), "y")


@register("add_ten", O.with_ctes("SELECT x1, CAST(x1 + 10 AS DOUBLE) AS y FROM simple_signals"))
def q_add_ten(spark, sf):
    return X.simple_signals(spark, sf).select("x1", add_ten("x1").alias("y"))


@register("is_blank", "SELECT doc_id, (text IS NULL OR NOT regexp_matches(text, "
                      "'[^\\x00-\\x20]')) AS text_is_blank FROM documents")
def q_is_blank(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", is_blank("text").alias("text_is_blank"))


@register("normalise_text", "SELECT doc_id, upper(regexp_replace(lang, "
                            "'^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g')) AS lang_norm, "
                            "upper(regexp_replace(source, '^[\\x00-\\x20]+|[\\x00-\\x20]+\\z', "
                            "'', 'g')) AS source_norm FROM documents")
def q_normalise_text(spark, sf):
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", normalise_text("lang").alias("lang_norm"),
                       normalise_text("source").alias("source_norm"))


@register("preview_rows", COOK + ' ORDER BY s.root_id, c.meta_past_halflife NULLS FIRST LIMIT 20')
def q_preview_rows(spark, sf):
    return preview_rows(_round_score(_cooked(spark, sf)), ["root_id", "meta_past_halflife"], 20)


@register("preview_cooked", COOK + ' ORDER BY s.root_id, c.meta_past_halflife NULLS FIRST LIMIT 20')
def q_preview_cooked(spark, sf):
    return _round_score(preview_cooked(_raw(spark, sf), _dim(spark)))


@register("count_rows", O.with_ctes("SELECT COUNT(*) AS n FROM raw_signals"))
def q_count_rows(spark, sf):
    return count_rows(_raw(spark, sf))


# ----------------------------------------------------------------------------- dimension joins
@register("lookup_halflife", O.with_ctes(
    "SELECT i.meta_past_id, c.meta_past_halflife FROM (SELECT DISTINCT meta_past_id "
    "FROM raw_signals) i LEFT JOIN current_dim c ON i.meta_past_id = c.dim_key"))
def q_lookup_halflife(spark, sf):
    return lookup_halflife(X.subtype_dim(spark), _raw(spark, sf))


@register("dim_duplicate_keys", O.with_ctes(
    "SELECT d.meta_past_id, d.n_versions, COALESCE(f.fact_rows, 0) AS fact_rows, "
    "COALESCE(f.fact_rows, 0) * (d.n_versions - 1) AS extra_rows FROM "
    "(SELECT dim_key AS meta_past_id, COUNT(*) AS n_versions FROM current_dim GROUP BY dim_key "
    "HAVING COUNT(*) > 1) d LEFT JOIN (SELECT meta_past_id, COUNT(*) AS fact_rows "
    "FROM raw_signals GROUP BY meta_past_id) f ON d.meta_past_id = f.meta_past_id"))
def q_dim_duplicate_keys(spark, sf):
    return dim_duplicate_keys(X.subtype_dim(spark), _raw(spark, sf))


@register("join_inner_alias", O.with_ctes(
    "SELECT l.root_id, l.meta_past_id AS l_meta_past_id, r.meta_past_id AS r_meta_past_id, "
    "r.meta_pat_id, r.meta_past_halflife, r.scd_is_active, r.scd_is_deleted "
    "FROM raw_signals l JOIN subtype_dim r ON l.meta_past_id = r.meta_past_id"))
def q_join_inner_alias(spark, sf):
    left = _raw(spark, sf).select("root_id", "meta_past_id")
    return join_inner_alias(left, X.subtype_dim(spark), "meta_past_id", "l", "r")


# ----------------------------------------------------------------------------- sinks
@register("replace_partition", O.cook_sql(
    key=f"CASE WHEN {PART_WHERE} THEN s.meta_past_id ELSE c.dim_key END"))
def q_replace_partition(spark, sf):
    """Backfill every hour (dimension key kept), then replace one hour, twice, with rows that
    keep the signal's key: only that hour changes."""
    name = _scored_table(spark, "sig_replace")
    W.append(spark, _cooked(spark, sf, key_side="dim"), name)
    fresh = cook_signals(X.raw_signals(spark, sf, PART_DATE, PART_HOUR), _dim(spark))
    W.replace_partition(spark, fresh, name, PART_DATE, PART_HOUR)
    W.replace_partition(spark, fresh, name, PART_DATE, PART_HOUR)
    return _readback(spark, name)


@register("load_csv_partition", O.cook_sql(
    key=f"CASE WHEN {PART_WHERE} THEN s.meta_past_id ELSE c.dim_key END"))
def q_load_csv_partition(spark, sf):
    """Fill a table (dimension key kept), then load one hour's staged files, whose rows keep the
    signal's key, into its partition, twice: only that hour changes."""
    name, staged = _scored_table(spark, "sig_load_part"), scratch_path(spark, "staged_hour")
    W.append(spark, _cooked(spark, sf, key_side="dim"), name)
    hour = cook_signals(X.raw_signals(spark, sf, PART_DATE, PART_HOUR), _dim(spark))
    W.write_csv_files(hour.drop(*PARTITION_COLUMNS), staged, partition_by=())
    for _ in range(2):
        load_csv_partition(spark, staged, name, PART_DATE, PART_HOUR, ours=True)
    return _readback(spark, name)


TEXTS = "SELECT doc_id, text, lang FROM documents"


@register("save_csv_text", TEXTS)
def q_save_csv_text(spark, sf):
    """Whole document texts, line breaks and all, through a CSV table that is created with a half
    of them and gets the others by an append."""
    docs = X.table(spark, sf, "documents").select("doc_id", "text", "lang")
    half = F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))
    name = unique_name("sig_csv_text")
    W.save_table(docs.where(half), name, fmt="csv", path=scratch_path(spark, name))
    W.append(spark, docs.where(~half), name)
    return W.read_table(spark, name)


@register("write_csv_text", TEXTS)
def q_write_csv_text(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "csv_text")
    W.write_csv_files(docs, path, partition_by=())
    return W.read_csv_files(spark, path, docs.schema)


@register("write_csv_files", COOK)
def q_write_csv_files(spark, sf):
    path = scratch_path(spark, "scored_csv")
    W.write_csv_files(_cooked(spark, sf), path)
    return _round_score(W.read_csv_files(spark, path, SCORED_SCHEMA)
                        .select(*SCORED_SCHEMA.fieldNames()))


@register("append_partitioned", COOK)
def q_append_partitioned(spark, sf):
    name = _scored_table(spark, "sig_append")
    W.append(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("append_once", COOK)
def q_append_once(spark, sf):
    """Two batches, one of them twice: its rows are there once."""
    name = unique_name("sig_once")
    W.create_batched_table(spark, name, SCORED_SCHEMA, location=scratch_path(spark, name))
    cooked = _cooked(spark, sf)
    early = F.coalesce(F.col("date") < F.lit("2024-01-16").cast("date"), F.lit(False))
    for batch, rows in (("a", cooked.where(early)), ("b", cooked.where(~early)), ("a", cooked.where(early))):
        W.append_once(rows, name, batch)
    return _readback(spark, name)


@register("compact_appends", COOK)
def q_compact_appends(spark, sf):
    """Two appends leave two files an hour; the compaction leaves one."""
    name = _scored_table(spark, "sig_compact")
    cooked = _cooked(spark, sf)
    odd = F.coalesce(F.col("root_id") % 2 == 1, F.lit(False))
    W.append(spark, cooked.where(odd), name)
    W.append(spark, cooked.where(~odd), name)
    W.compact(spark, name)
    return _readback(spark, name)


@register("write_few_columns", O.with_ctes('SELECT party_id, "date", "hour" FROM raw_signals'))
def q_write_few_columns(spark, sf):
    name = unique_name("sig_few")
    W.save_table(score_signals(_raw(spark, sf)).select("party_id", "date", "hour"), name,
                 path=scratch_path(spark, name))
    return spark.table(name)


@register("overwrite_existing", COOK)
def q_overwrite_existing(spark, sf):
    name = _scored_table(spark, "sig_overwrite")
    W.overwrite_rows(spark, _cooked(spark, sf), name)
    W.overwrite_rows(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("save_table", COOK)
def q_save_table(spark, sf):
    name = unique_name("sig_save")
    W.save_table(_cooked(spark, sf), name, path=scratch_path(spark, name))
    return _readback(spark, name)


@register("save_table_orc", COOK)
def q_save_table_orc(spark, sf):
    name = unique_name("sig_orc")
    W.save_table(_cooked(spark, sf), name, fmt="orc", path=scratch_path(spark, name))
    return _readback(spark, name)


@register("save_table_orc_partitioned", COOK)
def q_save_table_orc_partitioned(spark, sf):
    name = unique_name("sig_orc_part")
    W.save_table(_cooked(spark, sf), name, fmt="orc", partition_by=PARTITION_COLUMNS,
                 path=scratch_path(spark, name))
    return _readback(spark, name)


@register("append_orc_partitioned", COOK)
def q_append_orc_partitioned(spark, sf):
    name = _scored_table(spark, "sig_orc_append", fmt="orc")
    W.append(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("append_orc", COOK)
def q_append_orc(spark, sf):
    name = _scored_table(spark, "sig_orc_flat", fmt="orc", partitioned=False)
    W.append(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("save_table_csv", COOK)
def q_save_table_csv(spark, sf):
    name = unique_name("sig_csv")
    W.save_table(_cooked(spark, sf), name, fmt="csv", path=scratch_path(spark, name))
    return _readback(spark, name)


@register("append_csv_partitioned", COOK)
def q_append_csv_partitioned(spark, sf):
    name = _scored_table(spark, "sig_csv_append", fmt="csv")
    W.append(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("overwrite_csv", COOK)
def q_overwrite_csv(spark, sf):
    name = _scored_table(spark, "sig_csv_over", fmt="csv", partitioned=False)
    W.overwrite_rows(spark, _cooked(spark, sf), name)
    W.overwrite_rows(spark, _cooked(spark, sf), name)
    return _readback(spark, name)


@register("save_table_parquet", COOK)
def q_save_table_parquet(spark, sf):
    name = unique_name("sig_parquet")
    W.save_table(_cooked(spark, sf), name, fmt="parquet", path=scratch_path(spark, name))
    return _readback(spark, name)


@register("save_table_gzip_partitioned", COOK)
def q_save_table_gzip_partitioned(spark, sf):
    name = unique_name("sig_gzip")
    W.save_table(_cooked(spark, sf), name, fmt="parquet", partition_by=PARTITION_COLUMNS,
                 compression="gzip", path=scratch_path(spark, name))
    return _readback(spark, name)


@register("overwrite_gzip_partitioned", O.cook_sql(
    key=f"CASE WHEN {PART_WHERE} THEN s.meta_past_id ELSE c.dim_key END"))
def q_overwrite_gzip_partitioned(spark, sf):
    """Fill a gzip table (dimension key kept), then overwrite dynamically with one hour of rows
    that keep the signal's key: only that hour's partition is replaced."""
    name = _scored_table(spark, "sig_gzip_over", compression="gzip")
    W.overwrite_rows(spark, _cooked(spark, sf, key_side="dim"), name)
    hour_rows = cook_signals(X.raw_signals(spark, sf, PART_DATE, PART_HOUR), _dim(spark))
    W.overwrite_rows(spark, hour_rows, name, partition_mode="dynamic")
    return _readback(spark, name)


@register("score_and_save", O.with_ctes(
    "SELECT x1, round(" + O.speedtest_sql("TRY_CAST(x1 AS DOUBLE)") + ", 6) AS y "
    "FROM simple_strings"))
def q_score_and_save(spark, sf):
    name = unique_name("sig_simple_scored")
    W.score_and_save(X.simple_signals(spark, sf, as_strings=True), name,
                     path=scratch_path(spark, name))
    return _round_score(spark.table(name), "y")


# ----------------------------------------------------------------------------- streaming
@register("cook_signals_stream", COOK)
def q_cook_signals_stream(spark, sf):
    """The job's incremental form: raw signals landed as files in two arrivals, each taken up
    by an availableNow run of the stream; the exactly-once sink read back."""
    from sigscore.schemas import SCORED_COLUMNS
    from sigscore.streaming.hourly import read_raw_stream, start_cook_stream
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing", "stream_out", "stream_ckpt"))
    raw = _raw(spark, sf)
    # Null-safe split: every row lands in exactly one arrival.
    first_half = F.coalesce(F.col("date") < F.lit("2024-01-16").cast("date"), F.lit(False))
    for arrival, part in (("a=1", first_half), ("a=2", ~first_half)):
        raw.where(part).write.parquet(f"{landing}/{arrival}")
        start_cook_stream(read_raw_stream(spark, f"{landing}/*"), _dim(spark), out,
                          ckpt).awaitTermination()
    return _round_score(spark.read.parquet(out).select(*SCORED_COLUMNS))


@register("cook_signals_batches", COOK)
def q_cook_signals_batches(spark, sf):
    """The incremental job with the dimension read and measured in each micro-batch, over two
    arrivals, into a table that takes each batch once."""
    from sigscore.streaming.hourly import read_raw_stream, start_cook_batches
    landing, ckpt = (scratch_path(spark, n) for n in ("landing_b", "batches_ckpt"))
    name = unique_name("sig_batches")
    W.create_batched_table(spark, name, SCORED_SCHEMA, location=scratch_path(spark, name))
    raw = _raw(spark, sf)
    early = F.coalesce(F.col("date") < F.lit("2024-01-16").cast("date"), F.lit(False))
    for arrival, part in (("a=1", early), ("a=2", ~early)):
        raw.where(part).write.parquet(f"{landing}/{arrival}")
        start_cook_batches(read_raw_stream(spark, f"{landing}/*"), _dim, name, ckpt).awaitTermination()
    return _readback(spark, name)


# ----------------------------------------------------------------------------- job
@register("run_hour", O.cook_sql(where=PART_WHERE))
def q_run_hour(spark, sf):
    """Stage the raw signals as a table partitioned by date/hour, run the job for one hour."""
    raw_name = unique_name("sig_raw")
    W.save_table(_raw(spark, sf), raw_name, fmt="parquet", partition_by=PARTITION_COLUMNS,
                 path=scratch_path(spark, raw_name))
    target = _scored_table(spark, "sig_job")
    cfg = JobConfig(source_table=raw_name, target_table=target,
                    dimension=lambda s: X.subtype_dim(s))
    run_hour(spark, cfg, PART_DATE, f"{PART_HOUR:02d}", "NA")
    return _readback(spark, target)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
