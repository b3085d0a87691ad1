"""Counts as text (F7), the Pass/Fail verdict (F8) and error text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the report contract.
PASS = "Pass"
FAIL = "Fail"
ZERO = "0"


def count_text(col: Column | str) -> Column:
    """a count as its decimal text."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("long").cast("string")


def pass_fail(source: Column | str, target: Column | str) -> Column:
    """F8: ``Pass`` unless the two count texts differ; NULL differs from any text."""
    s = F.col(source) if isinstance(source, str) else source
    t = F.col(target) if isinstance(target, str) else target
    return F.when(s.eqNullSafe(t), F.lit(PASS)).otherwise(F.lit(FAIL))


def verdict(source: str | None, target: str | None) -> str:
    """F8 on driver-side values (the per-table counts of a job)."""
    return PASS if source == target else FAIL


def error_text(exc: BaseException) -> str:
    """the text stored in ``log_details``."""
    return str(exc)
