"""DuckDB SQL for the fixture views and the score curves (the independent oracle).

The same derivations as ``sources.fixtures``, written as DuckDB SQL over the driver's tables;
the curves and their numbers are written out here once more, so that a wrong constant or formula
on the Spark side does not pass. Double constants are spelt as ``CAST('…' AS DOUBLE)``: a bare
decimal literal is DECIMAL in DuckDB.
"""

from __future__ import annotations

from sigscore.sources.fixtures import SUBTYPE_DIM_ROWS


def d(value: float) -> str:
    """A DOUBLE literal."""
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def speedtest_sql(x: str) -> str:
    """Arctangent arms around 80: 5 at 100 above it (slope 0.1), -2 at 0 below it (slope 0.6)."""
    up = f"{d(5)} / atan({d(0.1)} * ({d(100)} - {d(80)})) * atan({d(0.1)} * ({x} - {d(80)}))"
    down = f"{d(-2)} / atan({d(-0.6)} * {d(80)}) * atan({d(-0.6)} * ({d(80)} - {x}))"
    return f"(CASE WHEN {x} > {d(80)} THEN {up} ELSE {down} END + {d(0)})"


def hfc_sql(x: str) -> str:
    """Exponential decay (rate 1.2) from 0 towards -2."""
    return f"({d(2)} * exp({d(-1.2)} * {x}) - {d(2)} + {d(0)})"


DEFAULT_CURVES_SQL = {2: speedtest_sql, 1: hfc_sql}


def score_sql(tv: str = "technical_value", cr: str = "cust_relevance", st: str = "meta_past_id",
              curves=None, default: float = 0.0) -> str:
    """NULL inputs score NULL; then the subtype's curve of the product; else the default."""
    whens = " ".join(f"WHEN {st} = {int(code)} THEN {curve(f'({tv} * {cr})')}"
                     for code, curve in (curves or DEFAULT_CURVES_SQL).items())
    return (f"CASE WHEN {tv} IS NULL OR {cr} IS NULL OR {st} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"{whens} ELSE {d(default)} END")


RAW_SQL = f"""
SELECT user_id AS party_id,
       event_id % 97 AS building_port_id,
       event_id % 211 AS cpe_equipment_id,
       event_id % 13 AS cpe_port_id,
       printf('%012X', event_id) AS cpe_mac,
       upper(event_type) AS "trigger",
       ts AS ts_created,
       ts + INTERVAL '5' MINUTE AS ts_received,
       CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
            WHEN 'signup' THEN 4 ELSE 7 END AS BIGINT) AS meta_past_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS technical_value,
       (CASE WHEN event_type = 'click' THEN {d(0.01)} ELSE {d(1.0)} END)
         * (1 + event_id % 4) / 2 AS cust_relevance,
       event_id AS root_id,
       CAST(ts AS DATE) AS "date",
       CAST(hour(ts) AS INTEGER) AS "hour"
FROM events"""

DIM_SQL = ("SELECT * FROM (VALUES "
           + ", ".join("(" + ", ".join([f"CAST({a} AS BIGINT)", f"CAST({b} AS BIGINT)",
                                        f"CAST({c} AS BIGINT)", f"CAST({e} AS INTEGER)",
                                        f"CAST({f} AS INTEGER)"]) + ")"
                       for a, b, c, e, f in SUBTYPE_DIM_ROWS)
           + ") AS t(meta_past_id, meta_pat_id, meta_past_halflife, scd_is_active, "
             "scd_is_deleted)")

SIMPLE_SQL = """
SELECT CAST(trunc(l_quantity) AS INTEGER) AS x1,
       CAST(l_linenumber AS INTEGER) AS x2,
       CAST(round(l_discount * 100) AS INTEGER) AS x3
FROM lineitem"""

SIMPLE_STRING_SQL = f"""
SELECT CAST(x1 AS VARCHAR) AS x1, CAST(x2 AS VARCHAR) AS x2, CAST(x3 AS VARCHAR) AS x3
FROM ({SIMPLE_SQL}) s"""


CTES = (f"WITH raw_signals AS ({RAW_SQL}),\n subtype_dim AS ({DIM_SQL}),\n"
        f" simple_signals AS ({SIMPLE_SQL}),\n simple_strings AS ({SIMPLE_STRING_SQL}),\n"
        f" scored AS (SELECT *, {score_sql()} AS score FROM raw_signals),\n"
        " current_dim AS (SELECT meta_past_id AS dim_key, meta_past_halflife FROM subtype_dim"
        " WHERE scd_is_active = 1 AND scd_is_deleted = 0)\n")

SCORED_SELECT = ('s.party_id, s.building_port_id, s.cpe_equipment_id, s.cpe_port_id, s.cpe_mac, '
                 's."trigger", s.ts_created, s.ts_received, {key} AS meta_past_id, '
                 'c.meta_past_halflife, round(s.score, 6) AS score, s.root_id, s."date", s."hour"')


def cook_sql(key: str = "s.meta_past_id", where: str = "") -> str:
    """The 14 scored columns; ``key`` picks which side's subtype id is kept."""
    sql = (CTES + "SELECT " + SCORED_SELECT.format(key=key)
           + " FROM scored s LEFT JOIN current_dim c ON s.meta_past_id = c.dim_key")
    return sql + (f" WHERE {where}" if where else "")


def with_ctes(select: str) -> str:
    """A SELECT over the fixture views, with their definitions as CTEs."""
    return CTES + select


# A dimension that grows with the data (one row per customer), and facts with a dominant key,
# NULL keys and a long tail: for the joins beyond the broadcast budget.
WIDE_CTES = CTES.replace("WITH raw_signals AS (", "WITH narrow_signals AS (", 1).replace(
    "),\n subtype_dim AS (", """),
 raw_signals AS (SELECT * REPLACE (CASE WHEN root_id % 3 = 0 THEN 2 WHEN root_id % 7 = 0 THEN NULL
   ELSE root_id % 997 + 1 END AS meta_past_id) FROM narrow_signals),
 subtype_dim AS (SELECT c_custkey AS meta_past_id, CAST(c_nationkey AS BIGINT) AS meta_pat_id,
   CAST(c_custkey % 89 AS BIGINT) AS meta_past_halflife,
   CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS INTEGER) AS scd_is_active,
   CAST(CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS scd_is_deleted
   FROM customer),
 small_dim AS (""", 1)
COOK_WIDE_SQL = (WIDE_CTES + "SELECT " + SCORED_SELECT.format(key="s.meta_past_id")
                 + " FROM scored s LEFT JOIN current_dim c ON s.meta_past_id = c.dim_key")
