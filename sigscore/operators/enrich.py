"""Scoring and half-life enrichment of raw signals: the hourly job's transformation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigscore.functions.curves import DEFAULT_CURVES, Curve, score_expr, speedtest
from sigscore.operators.dimension import dim_current
from sigscore.operators.projections import with_text_timestamps
from sigscore.operators.sizing import DEFAULT_BROADCAST_MAX_BYTES, lookup_join
from sigscore.schemas import SCORED_COLUMNS, SCORED_NO_HALFLIFE_COLUMNS

KEY_SIDES = ("fact", "dim")


def score_signals(raw: DataFrame, curves: Mapping[int, Curve] | None = None,
                  default: float | None = 0.0) -> DataFrame:
    """Raw signals with ``score`` added, in the 13-column scored layout (no half-life)."""
    scored = raw.withColumn("score", score_expr("technical_value", "cust_relevance",
                                                "meta_past_id", curves, default))
    return scored.select(*SCORED_NO_HALFLIFE_COLUMNS)


def with_score_by_subtype(raw: DataFrame, python_curves: Mapping[int, Curve],
                          curves: Mapping[int, Curve] | None = None,
                          default: float | None = 0.0) -> DataFrame:
    """Raw signals with ``score``, where a caller's Python curve (``python_curves``: vectorised UDFs
    by subtype) is fed the complete signals of its own subtype and nothing else.

    Within one CASE a UDF is evaluated for every row. Here each Python curve gets a narrow branch
    whose filter on the subtype stands below the UDF and reaches the scan; the rest is scored
    natively; the branches are put together by a union, without a shuffle. Every row is in exactly
    one branch: incomplete signals and other subtypes in the native one.
    """
    x = F.col("technical_value") * F.col("cust_relevance")
    whole = F.col("technical_value").isNotNull() & F.col("cust_relevance").isNotNull()
    subtype = F.col("meta_past_id")
    native = {k: c for k, c in (DEFAULT_CURVES if curves is None else curves).items()
              if k not in python_curves}
    own = whole & subtype.isin([int(k) for k in python_curves])
    out = raw.where(~F.coalesce(own, F.lit(False))).withColumn(
        "score", score_expr("technical_value", "cust_relevance", "meta_past_id", native, default))
    for code, curve in python_curves.items():
        branch = raw.where(whole & (subtype == F.lit(int(code)).cast("bigint")))
        out = out.unionByName(branch.withColumn("score", curve(x).cast("double")))
    return out


def score_simple(df: DataFrame, column: str = "x1", out: str = "y",
                 curve: Curve = speedtest) -> DataFrame:
    """``column`` and its curve score ``out``. Text input is read with ``try_cast``: a value
    that is not a number scores NULL instead of failing the job."""
    return df.select(column, curve(F.col(column).try_cast("double")).alias(out))


def score_signals_text_ts(raw: DataFrame, curves: Mapping[int, Curve] | None = None) -> DataFrame:
    """As ``score_signals`` with both timestamps rendered as text."""
    return with_text_timestamps(score_signals(raw, curves))


def enrich_halflife(scored: DataFrame, current_dim: DataFrame, key_side: str = "fact",
                    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Attach ``meta_past_halflife`` by a left outer join on ``meta_past_id``.

    A subtype with several current versions repeats the signal once per version (the join's
    meaning; see ``dim_duplicate_keys``). ``key_side="fact"`` keeps the signal's own id;
    ``key_side="dim"`` keeps the dimension's id, which is NULL for an unmatched signal.
    The dimension is broadcast after its size is measured; beyond the budget the join shuffles,
    and adaptive execution splits the partitions of dominant or NULL subtypes (``lookup_join``).
    """
    if key_side not in KEY_SIDES:
        raise ValueError(f"key_side must be one of {KEY_SIDES}")
    dim = current_dim.select(F.col("meta_past_id").alias("_dim_key"),
                             F.col("meta_past_halflife").cast("bigint").alias("meta_past_halflife"))
    joined = lookup_join(scored, dim, "meta_past_id", "_dim_key", "left",
                         broadcast_max_bytes=broadcast_max_bytes)
    key = F.col("meta_past_id") if key_side == "fact" else F.col("_dim_key")
    return joined.select(*[key.alias("meta_past_id") if c == "meta_past_id" else F.col(c)
                           for c in SCORED_COLUMNS])


def cook_signals(raw: DataFrame, dim: DataFrame, key_side: str = "fact",
                 curves: Mapping[int, Curve] | None = None,
                 broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Score, keep current dimension rows, attach the half-life, project the 14 columns.

    One narrow stage over the fact: native score expression + broadcast hash join probe.
    """
    return enrich_halflife(score_signals(raw, curves), dim_current(dim), key_side,
                           broadcast_max_bytes)
