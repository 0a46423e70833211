"""Previews and schema description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def preview_rows(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows by a key that makes them determinate.

    Planned as a per-task top-n followed by one merge of at most ``n`` rows per task.
    """
    return df.orderBy(*order_by).limit(n)


def preview_cooked(raw: DataFrame, dim: DataFrame, key: str = "root_id",
                   then: Sequence[str] = ("meta_past_halflife",), n: int = 20) -> DataFrame:
    """The first ``n`` rows of ``cook_signals`` by ``key`` and ``then``, with the top n taken below
    the join.

    The left join keeps every signal, so the first n rows come from the signals with the n smallest
    keys: those are found first (a top n of one column per task), and only signals up to the n-th of
    them, ties included, are scored and joined. The bound is a filter that reaches the scan.
    """
    from sigscore.operators.enrich import cook_signals
    smallest = raw.select(key).orderBy(key).limit(n).agg(
        F.max(key).alias("last"), F.count("*").alias("rows")).first()
    first = raw
    if smallest["rows"] == n:  # nulls come first
        last = smallest["last"]
        low = F.col(key).isNull()
        first = raw.where(low if last is None else low | (F.col(key) <= F.lit(last)))
    return preview_rows(cook_signals(first, dim), [key, *then], n)


def describe_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as data: one row per column (metadata only, no scan)."""
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType()),
                           T.StructField("nullable", T.BooleanType())])
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, schema)
