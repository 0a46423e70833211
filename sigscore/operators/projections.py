"""Projections, added columns and simple filters (all narrow, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORE_INPUTS = ("meta_past_id", "technical_value", "cust_relevance")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Narrow to ``columns`` by name, in that order (pruned down to the scan)."""
    return df.select(*columns)


def select_score_inputs(df: DataFrame) -> DataFrame:
    """The three score inputs: subtype, technical value, customer relevance."""
    return df.select(*SCORE_INPUTS)


def select_two(df: DataFrame, first: str = "x1", second: str = "x2") -> DataFrame:
    """Two columns by name, in that order."""
    return df.select(first, second)


def add_null_column(df: DataFrame, name: str = "newCol", data_type: str = "int") -> DataFrame:
    """An all-NULL column with a concrete type (a bare NULL type cannot be written)."""
    return df.withColumn(name, F.lit(None).cast(data_type))


def add_product_column(df: DataFrame, name: str = "newCol", left: str = "x1",
                       right: str = "x2") -> DataFrame:
    """``name`` = ``left * right``."""
    return df.withColumn(name, F.col(left) * F.col(right))


def filter_gt(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` is greater than a literal (pushed to the scan when possible)."""
    return df.where(F.col(column) > F.lit(value))


def with_text_timestamps(df: DataFrame, columns: Sequence[str] = ("ts_created", "ts_received")
                         ) -> DataFrame:
    """Timestamps rendered as text, in place."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in columns else F.col(c)
                       for c in df.columns])
