"""Every registered query against its DuckDB oracle on the smallest tables, and its plan
free of Python evaluation (only the caller's-pandas-curve query runs Python, by design)."""

import pytest

import __spark_entry__ as E
from sigscore import registry
from sigscore.plans.inspect import plan_text
from tools.oracle_check import compare, duck

from conftest import SF_SMALL

NAMES = sorted(registry.queries())
PYTHON_BY_DESIGN = {"score_custom_curve"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[-2:] == ["date", "hour"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    text = plan_text(df)
    has_python = "EvalPython" in text
    assert has_python == (name in PYTHON_BY_DESIGN), text
    res = compare(df, E.oracle_sql().get(name), con)
    assert res["match"] in (True, None), res
    assert res["rows"] > 0
