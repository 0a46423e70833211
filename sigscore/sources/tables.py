"""Scans of catalog tables and Parquet folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _frame(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def parse_partition(date: str | dt.date, hour: int | str) -> tuple[dt.date, int]:
    """Validate a ``(date, hour)`` job argument once: ISO date, hour 0..23 (``"03"`` -> 3)."""
    day = date if isinstance(date, dt.date) else dt.date.fromisoformat(str(date).strip())
    h = int(str(hour).strip())
    if not 0 <= h <= 23:
        raise ValueError(f"hour out of range: {hour!r}")
    return day, h


def partition_predicate(date: str | dt.date, hour: int | str):
    """The ``date = … AND hour = …`` predicate of one partition."""
    day, h = parse_partition(date, hour)
    return (F.col("date") == F.lit(day)) & (F.col("hour") == F.lit(h))


def scan_partition(spark: SparkSession, source: str | DataFrame, date: str | dt.date,
                   hour: int | str) -> DataFrame:
    """All columns of one ``(date, hour)`` partition.

    On a table partitioned by ``date, hour`` the predicate becomes ``PartitionFilters`` and
    only that folder is listed and read.
    """
    return _frame(spark, source).where(partition_predicate(date, hour))


def scan_table(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Whole table (columns are pruned later by whatever the caller selects)."""
    return _frame(spark, source)
