"""Views over the driver's read-only tables in the shapes the job expects.

``raw_signals`` is derived from ``events``, ``simple_signals`` from ``lineitem``; the subtype
dimension is a handful of versioned rows. The same derivations are written in DuckDB SQL for
the oracle (``sigscore.oracle_sql``).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigscore.schemas import SUBTYPE_DIM_SCHEMA


def table(spark: SparkSession, sf_dir: str | os.PathLike, name: str) -> DataFrame:
    """One of the driver's tables, read from its Parquet file."""
    return spark.read.parquet(f"{os.fspath(sf_dir).rstrip('/')}/{name}.parquet")


def _subtype_of(event_type: Column) -> Column:
    return (F.when(event_type == "click", 1).when(event_type == "view", 2)
            .when(event_type == "purchase", 3).when(event_type == "signup", 4)
            .otherwise(7).cast("bigint"))


def hour_bounds(date: str | dt.date, hour: int) -> tuple[dt.datetime, dt.datetime]:
    """Start (inclusive) and end (exclusive) of an hour as naive datetimes."""
    day = date if isinstance(date, dt.date) else dt.date.fromisoformat(str(date))
    start = dt.datetime.combine(day, dt.time(int(hour)))
    return start, start + dt.timedelta(hours=1)


def raw_signals(spark: SparkSession, sf_dir: str, date: str | dt.date | None = None,
                hour: int | None = None) -> DataFrame:
    """Raw signals over ``events``; with ``date``/``hour`` only that hour is read.

    ``date``/``hour`` are derived from ``ts``, so an hour is a ``ts`` range: that range is
    pushed into the Parquet scan (row-group skipping), the exact partition test stays on top.
    """
    ev = table(spark, sf_dir, "events")
    if date is not None and hour is not None:
        # Zone-free literals: text parsed straight to TIMESTAMP_NTZ.
        start, end = (F.lit(b.isoformat(sep=" ")).cast("timestamp_ntz")
                      for b in hour_bounds(date, hour))
        ev = ev.where((F.col("ts") >= start) & (F.col("ts") < end))
    raw = raw_signals_from_events(ev)
    if date is not None and hour is not None:
        raw = raw.where((F.col("date") == F.lit(hour_bounds(date, hour)[0].date()))
                        & (F.col("hour") == F.lit(int(hour))))
    return raw


def raw_signals_from_events(ev: DataFrame) -> DataFrame:
    """The raw-signal projection of an ``events``-shaped frame
    (event_id, ts, user_id, event_type, value)."""
    event_id, event_type = F.col("event_id"), F.col("event_type")
    return ev.select(
        F.col("user_id").alias("party_id"),
        (event_id % 97).alias("building_port_id"),
        (event_id % 211).alias("cpe_equipment_id"),
        (event_id % 13).alias("cpe_port_id"),
        F.lpad(F.hex(event_id), 12, "0").alias("cpe_mac"),
        F.upper(event_type).alias("trigger"),
        F.col("ts").alias("ts_created"),
        (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("ts_received"),
        _subtype_of(event_type).alias("meta_past_id"),
        F.when(event_id % 50 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
        .alias("technical_value"),
        (F.when(event_type == "click", F.lit(0.01)).otherwise(F.lit(1.0))
         * (F.lit(1) + event_id % 4) / F.lit(2)).alias("cust_relevance"),
        event_id.alias("root_id"),
        F.col("ts").cast("date").alias("date"),
        F.hour("ts").cast("int").alias("hour"),
    )


# The versioned subtype rows of the test dimension
# (meta_past_id, meta_pat_id, meta_past_halflife, scd_is_active, scd_is_deleted).
SUBTYPE_DIM_ROWS = (
    (1, 10, 24, 1, 0),
    (2, 10, 48, 1, 0),
    (2, 10, 99, 0, 0),
    (3, 20, 72, 1, 1),
    (4, 20, 12, 1, 0),
    (4, 20, 36, 1, 0),
)


def subtype_dim(spark: SparkSession) -> DataFrame:
    """The versioned subtype dimension (a JDBC table in production, see ``sources.jdbc``)."""
    return spark.createDataFrame(list(SUBTYPE_DIM_ROWS), SUBTYPE_DIM_SCHEMA)


def simple_signals(spark: SparkSession, sf_dir: str, as_strings: bool = False) -> DataFrame:
    """Three-integer signals over ``lineitem``; ``as_strings`` gives the all-STRING table.

    ``round`` comes before the cast: a double-to-int cast truncates.
    """
    li = table(spark, sf_dir, "lineitem")
    out = li.select(F.col("l_quantity").cast("int").alias("x1"),
                    F.col("l_linenumber").cast("int").alias("x2"),
                    F.round(F.col("l_discount") * 100).cast("int").alias("x3"))
    if as_strings:
        out = out.select(*[F.col(c).cast("string").alias(c) for c in ("x1", "x2", "x3")])
    return out
