"""Size guard for broadcast joins, and the shuffle join used beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast budget: the measured size of the small side (fixed-width columns, plus the actual
# bytes of variable-width ones) must stay under this. 64 MB keeps the hash relation cheap to
# ship to a thousand executors.
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
                "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
_ROW_HEADER_BYTES = 8


KEYS_MOST = 1000  # distinct keys that a filter lists


def _fixed_width(data_type: T.DataType) -> int | None:
    name = data_type.simpleString()
    if name in _FIXED_WIDTH:
        return _FIXED_WIDTH[name]
    if isinstance(data_type, T.DecimalType):
        return 8 if data_type.precision <= 18 else 16
    return None


def measured_size(df: DataFrame, max_bytes: int) -> tuple[int, int] | None:
    """``(rows, bytes)`` of ``df`` when they are within ``max_bytes``, else ``None``.

    One distributed pass: every task counts its rows and sums the real byte length of their
    variable-width values (strings, binary; JSON text for nested types) and sends one row. Each
    value also counts an 8-byte slot.
    """
    fixed, variable = _ROW_HEADER_BYTES, []
    for field in df.schema.fields:
        width = _fixed_width(field.dataType)
        fixed += 8 if width is None else width
        if width is None:
            col = F.col(field.name)
            if not isinstance(field.dataType, (T.StringType, T.BinaryType)):
                col = F.to_json(col) if isinstance(field.dataType, (T.ArrayType, T.MapType,
                                                                   T.StructType)) \
                    else col.cast("string")
            variable.append(F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint"))
    var_sum = sum(variable[1:], variable[0]) if variable else F.lit(0).cast("bigint")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(var_sum), F.lit(0)).alias("v")).first()
    rows, size = int(row["n"]), int(row["n"]) * fixed + int(row["v"])
    return None if size > max_bytes or max_bytes < fixed else (rows, size)


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True when ``df``'s measured size is proven to be within ``max_bytes``."""
    return max_bytes >= 0 and measured_size(df, max_bytes) is not None


def lookup_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                how: str = "left",
                broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Fact-to-dimension equi-join: broadcast when the dimension's measured size is within
    the budget, else a sort-merge join whose shuffles the planner places.

    The broadcast path never shuffles the fact. Beyond it, adaptive execution splits every
    oversized fact partition by map output, whatever fills it: one hot key, many of them, or
    NULL keys. That holds for exchanges the planner inserts, so no ``repartition`` stands before
    the join. A streaming fact gets the same join without that split, which Spark has for
    batches only. A batch's dimension is first cut down to the keys that the fact has
    (``within_keys``). Key names must differ between the two sides.
    """
    if fits_broadcast(dim, broadcast_max_bytes):
        return fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key], how)
    if not fact.isStreaming:
        dim = within_keys(dim, dim_key, fact, fact_key)
    return fact.join(dim.hint("merge"), fact[fact_key] == dim[dim_key], how)


def within_keys(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    """The rows of ``dim`` whose key a row of ``fact`` may have: between its least and greatest key,
    and, where the distinct keys between them are few (KEYS_MOST), among them. Both are plain
    filters of values, which reach the scan of ``dim`` and skip files and row groups there. The
    keys are taken from one column of ``fact``, pre-aggregated per task."""
    keys = fact.select(F.col(fact_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    low, high = keys.agg(F.min("k"), F.max("k")).first()
    if low is None:
        return dim.where(F.lit(False))
    some = [r["k"] for r in keys.limit(KEYS_MOST + 1).collect()]
    if len(some) <= KEYS_MOST:
        return dim.where(F.col(dim_key).isin(some))
    return dim.where(F.col(dim_key).between(F.lit(low), F.lit(high)))
