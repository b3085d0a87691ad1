"""Date functions: year of a slice date (F1), ``yyyymmdd`` keys (F2), clocks."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the run-mode contract (must stay as they are):
#   "NONE"        -> run for today's date
#   "0000-01-01"  -> history run: copy everything, source filter PC >= 0000-01-01
#   "0001-01-01"  -> the floor the history run re-counts the target with
TODAY_TOKEN = "NONE"
HISTORY_DATE = "0000-01-01"
HISTORY_TARGET_FLOOR = "0001-01-01"

_ISO_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def check_iso_date(value: str) -> str:
    """Validate ``YYYY-MM-DD``. Year 0 is allowed (it is the history sentinel)."""
    if not isinstance(value, str) or not _ISO_DATE.match(value):
        raise ValueError(f"expected a date as YYYY-MM-DD, got {value!r}")
    year, month, day = (int(p) for p in value.split("-"))
    # datetime.date has no year 0; check month/day on a leap year stand-in.
    dt.date(year if year > 0 else 2000, month, day)
    return value


def year_of(value: str) -> int:
    """the year of an ISO date string, as the slice predicate uses it."""
    return int(check_iso_date(value).split("-")[0])


def date_lit(value: str) -> Column:
    """A DATE literal from an ISO string (works for year 0, unlike ``datetime.date``)."""
    return F.lit(check_iso_date(value)).cast("date")


def date_key(col: Column | str) -> Column:
    """a date (or timestamp) as the integer ``yyyymmdd``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyyMMdd").cast("int")


def date_key_of(value: str) -> int:
    """F2 on the driver, for one run date."""
    return int(check_iso_date(value).replace("-", ""))


def year_column(col: Column | str) -> Column:
    """The integer year of a date column (how the ``cda_year`` partition is derived)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c).cast("int")


class Clock:
    """wall clock of the job. Injected so reports are reproducible in tests."""

    def now(self) -> dt.datetime:
        return dt.datetime.now()

    def today(self) -> str:
        return self.now().strftime("%Y-%m-%d")


@dataclass(frozen=True)
class FixedClock(Clock):
    at: dt.datetime

    def now(self) -> dt.datetime:
        return self.at
