"""Synthetic simple signals: three uniform integers in 1..10 per row, generated on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigscore.session import default_parallelism

# Each generated column is uniform over the integers 1..10.
GEN_LOW, GEN_HIGH = 1, 10


def _uniform(seed: int) -> F.Column:
    return (F.floor(F.rand(seed) * (GEN_HIGH - GEN_LOW + 1)) + GEN_LOW).cast("int")


def generate_signals(spark: SparkSession, rows: int | DataFrame, seed: int = 7,
                     num_partitions: int | None = None, as_strings: bool = False) -> DataFrame:
    """``rows`` generated signals ``(x1, x2, x3)``.

    ``rows`` is a count (``spark.range`` spreads it over ``num_partitions`` tasks) or a frame,
    which yields one generated row per input row without counting it first. ``rand`` is seeded
    per partition, so a lost task regenerates the same values.
    """
    if isinstance(rows, DataFrame):
        base = rows.select()
    else:
        parts = num_partitions or default_parallelism(spark)
        base = spark.range(0, int(rows), 1, parts)
    out = base.select(*[_uniform(seed + i).alias(f"x{i + 1}") for i in range(3)])
    if as_strings:
        out = out.select(*[F.col(c).cast("string").alias(c) for c in out.columns])
    return out
