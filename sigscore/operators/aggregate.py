"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame) -> DataFrame:
    """Global row count as a one-row frame (partial counts per task, one final merge)."""
    return df.agg(F.count(F.lit(1)).alias("n"))
