"""Property: the native score expression equals a plain-Python evaluation of the formulas, on
random signals (NULLs, any subtype id, values on both sides of the threshold)."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sigscore.functions import curves as C
from sigscore.functions.curves import score_expr


def py_speedtest(x):
    if x > C.SPEEDTEST_ZERO:
        y = C.SPEEDTEST_K_POS * math.atan(C.SPEEDTEST_SLOPE_POS * (x - C.SPEEDTEST_ZERO))
    else:
        y = C.SPEEDTEST_K_NEG * math.atan(-C.SPEEDTEST_SLOPE_NEG * (C.SPEEDTEST_ZERO - x))
    return y + 0.0


def py_hfc(x):
    return C.HFC_SPAN * math.exp(-C.HFC_SLOPE * x) - C.HFC_SPAN + C.HFC_TOP


def py_score(tv, cr, sid):
    if tv is None or cr is None or sid is None:
        return None
    x = tv * cr
    if sid == C.SUBTYPE_SPEEDTEST:
        return py_speedtest(x)
    if sid == C.SUBTYPE_HFC:
        return py_hfc(x)
    return C.DEFAULT_SCORE


values = st.one_of(st.none(), st.floats(min_value=-100, max_value=1e4, allow_nan=False))
factors = st.one_of(st.none(), st.floats(min_value=0, max_value=10, allow_nan=False))
ids = st.one_of(st.none(), st.sampled_from([1, 2]), st.integers(-2**40, 2**40))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(values, factors, ids), min_size=1, max_size=60))
def test_score_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "tv double, cr double, id bigint")
    got = [r[0] for r in df.select(score_expr("tv", "cr", "id")).collect()]
    for (tv, cr, sid), g in zip(rows, got):
        want = py_score(tv, cr, sid)
        if want is None:
            assert g is None
        else:
            assert g == pytest.approx(want, rel=1e-12, abs=1e-12), (tv, cr, sid)
