"""Static schemas of the signal tables and the column order of the scored contract."""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_COLUMNS = ("date", "hour")

RAW_SCHEMA = T.StructType([
    T.StructField("party_id", T.LongType()),
    T.StructField("building_port_id", T.LongType()),
    T.StructField("cpe_equipment_id", T.LongType()),
    T.StructField("cpe_port_id", T.LongType()),
    T.StructField("cpe_mac", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("ts_created", T.TimestampNTZType()),
    T.StructField("ts_received", T.TimestampNTZType()),
    T.StructField("meta_past_id", T.LongType()),
    T.StructField("technical_value", T.DoubleType()),
    T.StructField("cust_relevance", T.DoubleType()),
    T.StructField("root_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])

# Scored layout before the half-life is attached: `score` sits between the subtype and root_id.
SCORED_NO_HALFLIFE_COLUMNS = (
    "party_id", "building_port_id", "cpe_equipment_id", "cpe_port_id", "cpe_mac", "trigger",
    "ts_created", "ts_received", "meta_past_id", "score", "root_id", "date", "hour",
)

# Final contract order: meta_past_halflife, then score, then root_id; partitions last.
SCORED_COLUMNS = (
    "party_id", "building_port_id", "cpe_equipment_id", "cpe_port_id", "cpe_mac", "trigger",
    "ts_created", "ts_received", "meta_past_id", "meta_past_halflife", "score", "root_id",
    "date", "hour",
)
SCORED_DATA_COLUMNS = SCORED_COLUMNS[:-2]

SCORED_SCHEMA = T.StructType([
    T.StructField("party_id", T.LongType()),
    T.StructField("building_port_id", T.LongType()),
    T.StructField("cpe_equipment_id", T.LongType()),
    T.StructField("cpe_port_id", T.LongType()),
    T.StructField("cpe_mac", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("ts_created", T.TimestampNTZType()),
    T.StructField("ts_received", T.TimestampNTZType()),
    T.StructField("meta_past_id", T.LongType()),
    T.StructField("meta_past_halflife", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("root_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])

SUBTYPE_DIM_SCHEMA = T.StructType([
    T.StructField("meta_past_id", T.LongType()),
    T.StructField("meta_pat_id", T.LongType()),
    T.StructField("meta_past_halflife", T.LongType()),
    T.StructField("scd_is_active", T.IntegerType()),
    T.StructField("scd_is_deleted", T.IntegerType()),
])

DIM_COLUMNS = ("meta_past_id", "meta_past_halflife", "scd_is_active", "scd_is_deleted")
DIM_COLUMNS_WIDE = ("meta_past_id", "meta_pat_id", "meta_past_halflife", "scd_is_active",
                    "scd_is_deleted")

SIMPLE_SCHEMA = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x1", "x2", "x3")])
SIMPLE_STRING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("x1", "x2", "x3")])


def ddl(schema: T.StructType) -> str:
    """Column list of a schema in SQL DDL form, names back-quoted (`trigger`, `date`)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


_TIMESTAMPS = {"timestamp", "timestamp_ntz"}


def check_schema(df_schema: T.StructType, expected: T.StructType,
                 columns: tuple[str, ...] | None = None) -> None:
    """Raise ``ValueError`` when a required column is missing or has another type.

    Metadata only (no data is read). The two timestamp types count as one, since a source
    table may store either.
    """
    have = {f.name: f.dataType.simpleString() for f in df_schema.fields}
    problems = []
    for field in expected.fields:
        if columns is not None and field.name not in columns:
            continue
        want = field.dataType.simpleString()
        got = have.get(field.name)
        if got is None:
            problems.append(f"missing {field.name}")
        elif got != want and not (got in _TIMESTAMPS and want in _TIMESTAMPS):
            problems.append(f"{field.name}: {got}, expected {want}")
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
