"""Small literal frames (samples, test rows)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def frame_from_rows(spark: SparkSession, rows: Iterable[Sequence],
                    schema: T.StructType | Sequence[str]) -> DataFrame:
    """Rows held on the driver as a frame; only for literals a caller already has in hand."""
    return spark.createDataFrame(list(rows), schema)

