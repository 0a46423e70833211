"""Reading the subtype dimension from a JDBC database.

Options come from the caller (URL, table, user, password, driver); nothing is defaulted. The
dimension is small: one partition is the norm, but the usual partitioning options pass through
when a big dimension should be read in parallel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sigscore.schemas import DIM_COLUMNS

_REQUIRED = ("url", "dbtable")


def jdbc_options(options: Mapping[str, str], partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Validated reader options; partitioning options only as a complete set."""
    opts = {str(k): str(v) for k, v in options.items()}
    missing = [k for k in _REQUIRED if k not in opts and not (k == "dbtable" and "query" in opts)]
    if missing:
        raise ValueError(f"missing JDBC options: {missing}")
    opts.setdefault("fetchsize", str(fetch_size))
    part = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(p is not None for p in part):
        if any(p is None for p in part):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions "
                             "go together")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def jdbc_scan(spark: SparkSession, options: Mapping[str, str], **partitioning) -> DataFrame:
    """Whole JDBC table; filters and column selections on the result are pushed to the DB."""
    return spark.read.format("jdbc").options(**jdbc_options(options, **partitioning)).load()


def jdbc_scan_pruned(spark: SparkSession, options: Mapping[str, str],
                     columns: Sequence[str] = ("meta_past_id",)) -> DataFrame:
    """JDBC table narrowed to some columns (the column list reaches the DB query)."""
    return jdbc_scan(spark, options).select(*columns)


def read_dimension(spark: SparkSession, source: Mapping[str, str] | str | DataFrame,
                   columns: Sequence[str] = DIM_COLUMNS) -> DataFrame:
    """The subtype dimension from JDBC options, a catalog table name or a frame."""
    if isinstance(source, DataFrame):
        df = source
    elif isinstance(source, str):
        df = spark.table(source)
    else:
        df = jdbc_scan(spark, source)
    return df.select(*columns)
