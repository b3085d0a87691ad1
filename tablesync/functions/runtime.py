"""Run-time text (F5) from two timestamps.

Below one minute the text is ``"<n> seconds"`` with the seconds truncated toward
zero; from one minute on it is ``"<m> minutes <s> seconds"`` with the minutes and
the remainder of a floored division by 60. There is no hour unit and no singular
form: 3725 s reads ``62 minutes 5 seconds``, 61 s reads ``1 minutes 1 seconds``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in seconds (double), exact to the microsecond.

    ``timestamp_diff`` works for TIMESTAMP and TIMESTAMP_NTZ alike and, unlike a
    cast to the session zone, never shifts an NTZ pair across a DST change.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return micros.cast("double") / F.lit(1_000_000.0)


def runtime_text_of_seconds(seconds: Column | str) -> Column:
    """F5 on a seconds column (double)."""
    s = _c(seconds).cast("double")
    rem = s % F.lit(60.0)  # same sign as s; s >= 60 here, so it is the floor remainder
    div = (s - rem) / F.lit(60.0)
    whole_minutes = F.floor(div) + F.when(div - F.floor(div) > F.lit(0.5), 1).otherwise(0)
    short = F.concat(s.cast("long").cast("string"), F.lit(" seconds"))
    long_ = F.concat(
        whole_minutes.cast("long").cast("string"),
        F.lit(" minutes "),
        rem.cast("long").cast("string"),
        F.lit(" seconds"),
    )
    return F.when(s < F.lit(60.0), short).otherwise(long_)


def runtime_text(start: Column | str, end: Column | str) -> Column:
    """F5(F6(start, end))."""
    return runtime_text_of_seconds(elapsed_seconds(start, end))
