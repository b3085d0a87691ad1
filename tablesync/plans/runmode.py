"""Run-mode resolution."""

from __future__ import annotations

from dataclasses import dataclass

from tablesync.functions.dates import HISTORY_DATE, TODAY_TOKEN, Clock, check_iso_date
from tablesync.operators.predicates import SliceSpec


@dataclass(frozen=True)
class RunMode:
    """The run date and whether this is a history (append everything) run."""

    date: str
    history: bool

    def day_slice(self) -> SliceSpec:
        """Batch job: one day, or everything for a history run."""
        return SliceSpec.history() if self.history else SliceSpec.day(self.date)

    def open_slice(self) -> SliceSpec:
        """Notify job: every day from the run date, or everything for a history run."""
        return SliceSpec.history() if self.history else SliceSpec.from_date(self.date)


def resolve_run_mode(incremental_date: str | None, clock: Clock | None = None) -> RunMode:
    """``NONE`` is today, ``0000-01-01`` is history, anything else a date.

    A missing value raises before any table runs. A malformed date raises too
    (deviation: the original only failed later, once per table).
    """
    if incremental_date is None:
        raise KeyError("the run date (incremental date) is required")
    value = incremental_date.strip()
    if value == TODAY_TOKEN:
        return RunMode((clock or Clock()).today(), False)
    if value == HISTORY_DATE:
        return RunMode(HISTORY_DATE, True)
    return RunMode(check_iso_date(value), False)
