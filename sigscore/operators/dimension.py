"""The versioned subtype dimension: current rows, lookups and a fan-out check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.operators.sizing import DEFAULT_BROADCAST_MAX_BYTES, lookup_join
from sigscore.schemas import DIM_COLUMNS, DIM_COLUMNS_WIDE


def dim_columns(dim: DataFrame) -> DataFrame:
    """The four dimension columns the job uses."""
    return dim.select(*DIM_COLUMNS)


def dim_columns_wide(dim: DataFrame) -> DataFrame:
    """The five dimension columns, ``meta_pat_id`` included."""
    return dim.select(*DIM_COLUMNS_WIDE)


def dim_current(dim: DataFrame) -> DataFrame:
    """Current versions only: active and not deleted (pushed to JDBC / Parquet)."""
    return dim.where((F.col("scd_is_active") == 1) & (F.col("scd_is_deleted") == 0))


def lookup_halflife(dim: DataFrame, ids: Iterable[int] | DataFrame,
                    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Current half-life(s) of each requested subtype id, NULL when it has no current version.

    ``ids`` is a caller's list of ids or a frame with a ``meta_past_id`` column (its distinct
    values, aggregated map-side first, are looked up). The three equality tests are separate
    filters, merged into one by Catalyst.
    """
    current = (dim.where(F.col("scd_is_active") == 1).where(F.col("scd_is_deleted") == 0)
               .select(F.col("meta_past_id").alias("_dim_key"), "meta_past_halflife"))
    if isinstance(ids, DataFrame):
        wanted = ids.select("meta_past_id").distinct()
    else:
        wanted = dim.sparkSession.createDataFrame(
            [(i,) for i in sorted({int(i) for i in ids})], "meta_past_id bigint")
    joined = lookup_join(wanted, current, "meta_past_id", "_dim_key", "left",
                         broadcast_max_bytes=broadcast_max_bytes)
    return joined.select("meta_past_id", "meta_past_halflife")


def dim_duplicate_keys(dim: DataFrame, fact: DataFrame | None = None) -> DataFrame:
    """Subtype ids with more than one current version, and what they do to a fact.

    Every fact row of such an id is repeated once per version by the enrichment join. With a
    fact, ``fact_rows`` counts its rows per id (partial aggregation per task, so a hot id
    costs one row per task in the shuffle) and ``extra_rows`` the rows the join adds.
    """
    dups = (dim_current(dim).groupBy("meta_past_id")
            .agg(F.count(F.lit(1)).alias("n_versions"))
            .where(F.col("n_versions") > 1))
    if fact is None:
        return dups
    per_id = fact.groupBy("meta_past_id").agg(F.count(F.lit(1)).alias("fact_rows"))
    out = dups.join(per_id, "meta_past_id", "left")
    rows = F.coalesce(F.col("fact_rows"), F.lit(0).cast("bigint"))
    return out.select("meta_past_id", "n_versions", rows.alias("fact_rows"),
                      (rows * (F.col("n_versions") - 1)).alias("extra_rows"))


def join_inner_alias(left: DataFrame, right: DataFrame, key: str = "meta_past_id",
                     left_alias: str = "l", right_alias: str = "r",
                     broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Inner equi-join of two aliased frames keeping both key columns, named
    ``<alias>_<key>``; other columns keep their names unless both sides have them.

    Planned like every fact-to-dimension join here: the right side is broadcast when its
    measured size is within the budget, else a shuffle join on the key.
    """
    both = (set(left.columns) & set(right.columns)) - {key}

    def renamed(df: DataFrame, alias: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{alias}_{c}") if c == key or c in both
                           else F.col(c) for c in df.columns])

    l, r = renamed(left, left_alias), renamed(right, right_alias)
    return lookup_join(l, r, f"{left_alias}_{key}", f"{right_alias}_{key}", "inner",
                       broadcast_max_bytes=broadcast_max_bytes)
