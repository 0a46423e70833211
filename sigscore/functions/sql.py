"""The score curves and text helpers as SQL: portable text, and Spark SQL functions.

``register_sql_functions`` makes them callable from ``spark.sql`` as temporary SQL functions;
Spark inlines a SQL function's body into the plan, so these run exactly like the Column
functions (codegen, no Python). The curve text is plain ANSI SQL (``atan``, ``exp``,
``CASE``), which DuckDB runs as well.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sigscore.functions import curves as C


def d(value: float) -> str:
    """A DOUBLE literal (a bare decimal literal would be DECIMAL)."""
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def speedtest_sql(x: str) -> str:
    """The speed-test curve of the SQL expression ``x`` as SQL text."""
    return (f"(CASE WHEN {x} > {d(C.SPEEDTEST_ZERO)} "
            f"THEN {d(C.SPEEDTEST_K_POS)} * atan({d(C.SPEEDTEST_SLOPE_POS)} * ({x} - "
            f"{d(C.SPEEDTEST_ZERO)})) "
            f"ELSE {d(C.SPEEDTEST_K_NEG)} * atan({d(-C.SPEEDTEST_SLOPE_NEG)} * "
            f"({d(C.SPEEDTEST_ZERO)} - {x})) END + {d(0.0)})")


def hfc_sql(x: str) -> str:
    """The HFC curve of the SQL expression ``x`` as SQL text."""
    return (f"({d(C.HFC_SPAN)} * exp({d(-C.HFC_SLOPE)} * {x}) - {d(C.HFC_SPAN)} "
            f"+ {d(C.HFC_TOP)})")


DEFAULT_CURVES_SQL = {C.SUBTYPE_SPEEDTEST: speedtest_sql, C.SUBTYPE_HFC: hfc_sql}


def score_sql(tv: str = "technical_value", cr: str = "cust_relevance",
              st: str = "meta_past_id", curves=None, default: float = C.DEFAULT_SCORE) -> str:
    """The subtype-dispatched score (NULL guard, curves, default) as SQL text."""
    x = f"({tv} * {cr})"
    parts = [f"CASE WHEN {tv} IS NULL OR {cr} IS NULL OR {st} IS NULL THEN CAST(NULL AS DOUBLE)"]
    for code, curve in (curves or DEFAULT_CURVES_SQL).items():
        parts.append(f"WHEN {st} = {int(code)} THEN {curve(x)}")
    parts.append(f"ELSE {d(default)} END")
    return " ".join(parts)


# name -> (parameters, return type, body); bodies use Spark SQL raw string literals.
SQL_FUNCTIONS = {
    "speedtest_score": ("x DOUBLE", "DOUBLE", speedtest_sql("x")),
    "hfc_score": ("x DOUBLE", "DOUBLE", hfc_sql("x")),
    "signal_score": ("technical_value DOUBLE, cust_relevance DOUBLE, subtype BIGINT", "DOUBLE",
                     score_sql("technical_value", "cust_relevance", "subtype")),
    "add_ten": ("x INT", "DOUBLE", "CAST(x + 10 AS DOUBLE)"),
    "is_blank": ("s STRING", "BOOLEAN", r"s IS NULL OR NOT (s RLIKE r'[^\x00-\x20]')"),
    "normalise_text": ("s STRING", "STRING",
                       r"upper(regexp_replace(s, r'^[\x00-\x20]+|[\x00-\x20]+\z', ''))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions of this session; return their names."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
