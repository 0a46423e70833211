"""Score curves as native Column expressions (constant-folded, whole-stage codegen).

Every function maps ``Column -> Column``; nothing here runs Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Curve = Callable[[Column], Column]

# ---------------------------------------------------------------------------------------------
# Fixed values. They must equal the reference curves for scores to match.
#   speed-test curve: zero threshold 80, positive slope 0.1, negative slope 0.6,
#                     positive maximum 5 reached at x = 100, negative maximum -2
#   HFC curve:        slope 1.2, top 0, bottom -2
#   subtype codes:    2 -> speed-test curve, 1 -> HFC curve, any other -> 0.0
# ---------------------------------------------------------------------------------------------
SPEEDTEST_ZERO = 80.0
SPEEDTEST_SLOPE_POS = 0.1
SPEEDTEST_SLOPE_NEG = 0.6
SPEEDTEST_MAX_POS = 5.0
SPEEDTEST_MAX_NEG = -2.0
SPEEDTEST_POS_ANCHOR = 100.0
HFC_SLOPE = 1.2
HFC_TOP = 0.0
HFC_BOTTOM = -2.0
SUBTYPE_SPEEDTEST = 2
SUBTYPE_HFC = 1
DEFAULT_SCORE = 0.0

# Scale factors of the two arctangent arms, folded once on the driver.
SPEEDTEST_K_POS = SPEEDTEST_MAX_POS / math.atan(
    SPEEDTEST_SLOPE_POS * (SPEEDTEST_POS_ANCHOR - SPEEDTEST_ZERO))
SPEEDTEST_K_NEG = SPEEDTEST_MAX_NEG / math.atan(-SPEEDTEST_SLOPE_NEG * SPEEDTEST_ZERO)
HFC_SPAN = HFC_TOP - HFC_BOTTOM


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speedtest(x: Column | str) -> Column:
    """Asymmetric arctangent around the zero threshold; not clipped at either maximum.

    ``+ 0.0`` turns the ``-0.0`` produced exactly at the threshold into ``0.0``.
    """
    x = _c(x)
    pos = F.lit(SPEEDTEST_K_POS) * F.atan(F.lit(SPEEDTEST_SLOPE_POS) * (x - F.lit(SPEEDTEST_ZERO)))
    neg = F.lit(SPEEDTEST_K_NEG) * F.atan(F.lit(-SPEEDTEST_SLOPE_NEG) * (F.lit(SPEEDTEST_ZERO) - x))
    return F.when(x > F.lit(SPEEDTEST_ZERO), pos).otherwise(neg) + F.lit(0.0)


def hfc(x: Column | str) -> Column:
    """Negative exponential decay from ``HFC_TOP`` at x = 0 towards ``HFC_BOTTOM``."""
    x = _c(x)
    return (F.lit(HFC_SPAN) * F.exp(F.lit(-HFC_SLOPE) * x) - F.lit(HFC_SPAN)
            + F.lit(HFC_TOP))


DEFAULT_CURVES: Mapping[int, Curve] = {SUBTYPE_SPEEDTEST: speedtest, SUBTYPE_HFC: hfc}


def score_expr(technical_value: Column | str = "technical_value",
               cust_relevance: Column | str = "cust_relevance",
               subtype: Column | str = "meta_past_id",
               curves: Mapping[int, Curve] | None = None,
               default: float | None = DEFAULT_SCORE) -> Column:
    """Score of one signal: ``curves[subtype](technical_value * cust_relevance)``.

    Builds one ``CASE`` expression. The result is NULL when any input is NULL (whatever the
    subtype), the curve of a matching subtype otherwise, and ``default`` for any other
    subtype. The subtype is compared as BIGINT, never narrowed. A curve is any
    ``Column -> Column`` callable: the native curves here, a caller's own expression, or a
    vectorised ``pandas_udf``.
    """
    tv, cr, st = _c(technical_value), _c(cust_relevance), _c(subtype)
    x = tv * cr
    expr = F.when(tv.isNull() | cr.isNull() | st.isNull(), F.lit(None).cast("double"))
    for code, curve in (curves if curves is not None else DEFAULT_CURVES).items():
        expr = expr.when(st == F.lit(int(code)).cast("bigint"), curve(x).cast("double"))
    return expr.otherwise(F.lit(default).cast("double"))


def add_ten(x: Column | str) -> Column:
    """``x + 10`` as DOUBLE (integer addition first, then the widening)."""
    return (_c(x) + F.lit(10)).cast("double")
