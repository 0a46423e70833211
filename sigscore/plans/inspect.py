"""Reading physical plans: the checks behind 'pushed down', 'broadcast', 'no Python'."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Iterable

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def check_plan(df: DataFrame, present: Iterable[str] = (), absent: Iterable[str] = (),
               mode: str = "formatted") -> str:
    """Raise ``AssertionError`` unless every ``present`` marker is in the plan and no
    ``absent`` marker is; return the plan text."""
    text = plan_text(df, mode)
    missing = [m for m in present if m not in text]
    found = [m for m in absent if m in text]
    if missing or found:
        raise AssertionError(f"plan check failed: missing={missing} unexpected={found}\n{text}")
    return text


def exchange_count(df: DataFrame) -> int:
    """Number of shuffle exchanges in the (pre-AQE) physical plan."""
    return plan_text(df, "simple").count("Exchange hashpartitioning")
