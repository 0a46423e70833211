"""Golden values and properties of the score curves and the dispatch."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigscore.functions import curves as C
from sigscore.functions.curves import add_ten, hfc, score_expr, speedtest

# Golden values (our own evaluation of the published formulas): x, speed-test, HFC.
GOLDEN = [
    (-50.0, -2.010336368060185, 2.2840147796313685e+26),
    (0.0, -2.0, 0.0),
    (0.5, -1.9998310026798072, -0.9023767278119472),
    (1.0, -1.9996598670987775, -1.3976115761755956),
    (40.0, -1.9731448832147043, -2.0),
    (79.0, -0.6973307774674625, -2.0),
    (80.0, 0.0, -2.0),
    (81.0, 0.4501141124461773, -2.0),
    (90.0, 3.546940671901307, -2.0),
    (100.0, 5.0, -2.0),
    (200.0, 6.7184068002648045, -2.0),
    (1e6, 7.093836179138179, -2.0),
]


def _eval(spark, fn, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_speedtest_golden(spark):
    got = _eval(spark, speedtest, [g[0] for g in GOLDEN])
    for (x, want, _), v in zip(GOLDEN, got):
        assert v == pytest.approx(want, rel=1e-12, abs=1e-12), x


def test_hfc_golden(spark):
    got = _eval(spark, hfc, [g[0] for g in GOLDEN])
    for (x, _, want), v in zip(GOLDEN, got):
        assert v == pytest.approx(want, rel=1e-12, abs=1e-12), x


def test_threshold_is_positive_zero(spark):
    v = _eval(spark, speedtest, [80.0])[0]
    assert v == 0.0 and math.copysign(1.0, v) == 1.0


def test_curves_not_clipped(spark):
    top = _eval(spark, speedtest, [1e9])[0]
    assert top > C.SPEEDTEST_MAX_POS
    assert top == pytest.approx(C.SPEEDTEST_K_POS * math.pi / 2, rel=1e-6)


def _score_rows(spark, rows):
    df = spark.createDataFrame(rows, "tv double, cr double, id bigint")
    return [r[0] for r in df.select(score_expr("tv", "cr", "id")).collect()]


def test_dispatch(spark):
    rows = [(50.0, 2.0, 2), (0.5, 1.0, 1), (10.0, 1.0, 3), (10.0, 1.0, 7), (10.0, 1.0, 0)]
    got = _score_rows(spark, rows)
    assert got[0] == pytest.approx(5.0)
    assert got[1] == pytest.approx(-0.9023767278119472)
    assert got[2:] == [0.0, 0.0, 0.0]


def test_null_in_any_argument_gives_null(spark):
    rows = [(None, 1.0, 2), (1.0, None, 1), (1.0, 1.0, None), (None, 1.0, 7)]
    assert _score_rows(spark, rows) == [None, None, None, None]


def test_subtype_compared_as_bigint(spark):
    # 2**32 + 2 must not wrap onto subtype 2.
    assert _score_rows(spark, [(100.0, 1.0, 2 ** 32 + 2)]) == [0.0]


def test_custom_curve_and_default(spark):
    df = spark.createDataFrame([(3.0, 1.0, 5), (3.0, 1.0, 9)], "tv double, cr double, id bigint")
    expr = score_expr("tv", "cr", "id", curves={5: lambda x: x * 2}, default=-1.0)
    assert [r[0] for r in df.select(expr).collect()] == [6.0, -1.0]


def test_pandas_curve(spark):
    import pandas as pd
    from pyspark.sql import types as T

    @F.pandas_udf(T.DoubleType())
    def triple(x: pd.Series) -> pd.Series:
        return x * 3

    df = spark.createDataFrame([(2.0, 1.0, 5), (2.0, 1.0, 2)], "tv double, cr double, id bigint")
    out = [r[0] for r in df.select(score_expr("tv", "cr", "id",
                                              curves={5: triple, **C.DEFAULT_CURVES})).collect()]
    assert out[0] == 6.0
    assert out[1] == pytest.approx(-2.0 * 1.0 + 0.0, abs=0.01)  # speed-test near -2


def test_add_ten(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert [r[0] for r in df.select(add_ten("x")).collect()] == [11.0, None]


finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=20, deadline=None)
@given(st.lists(finite, min_size=2, max_size=40))
def test_speedtest_monotone(spark, xs):
    xs = sorted(xs)
    ys = _eval(spark, speedtest, xs)
    assert all(a <= b + 1e-12 for a, b in zip(ys, ys[1:]))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=-50, max_value=1e4, allow_nan=False), min_size=2,
                max_size=40))
def test_hfc_decreasing_above_floor(spark, xs):
    xs = sorted(xs)
    ys = _eval(spark, hfc, xs)
    assert all(a >= b - 1e-12 for a, b in zip(ys, ys[1:]))
    assert all(y >= C.HFC_BOTTOM - 1e-9 for y in ys)
