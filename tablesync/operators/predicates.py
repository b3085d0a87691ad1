"""Slice predicates on the day column ``PC``.

A :class:`SliceSpec` carries the three predicates one run needs: which source
rows to copy, which target rows to re-count, and which target rows the copy
replaces (``None`` means plain append). All are ordinary Catalyst predicates on
the partition columns, so they become ``PartitionFilters`` on a partitioned
table and ``PushedFilters`` on a plain Parquet source.

Three-valued logic matters (T1, T2): a row whose day is NULL never matches, so
it is never copied, never re-counted and never replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesync.functions.dates import HISTORY_DATE, HISTORY_TARGET_FLOOR, date_lit, year_of
from tablesync.session import quote_name

DEFAULT_YEAR_COLUMN = "cda_year"


@dataclass(frozen=True)
class SliceSpec:
    """Which rows one run reads, replaces and re-counts."""

    kind: str  # "day" | "from" | "history"
    date: str

    @staticmethod
    def day(date: str) -> SliceSpec:
        """One business day (batch job, P2 / P9)."""
        year_of(date)
        return SliceSpec("day", date)

    @staticmethod
    def from_date(date: str) -> SliceSpec:
        """Every day from ``date`` on (notify job, P3 / P10)."""
        year_of(date)
        return SliceSpec("from", date)

    @staticmethod
    def history() -> SliceSpec:
        """All dated rows, appended."""
        return SliceSpec("history", HISTORY_DATE)

    @property
    def appends(self) -> bool:
        return self.kind == "history"

    def source_filter(self, day_column: str, year_column: str | None = DEFAULT_YEAR_COLUMN) -> Column:
        """The rows to copy."""
        return self._filter(day_column, year_column, HISTORY_DATE)

    def target_filter(self, day_column: str, year_column: str | None = DEFAULT_YEAR_COLUMN) -> Column:
        """The rows to re-count in the target.

        The history run re-counts from ``0001-01-01``, so a year-0 row is
        counted at the source only (kept as in the original job).
        """
        return self._filter(day_column, year_column, HISTORY_TARGET_FLOOR)

    def replace_predicate(self, day_column: str) -> Column | None:
        """Target rows the copy supersedes; ``None`` for history (no delete).

        The day form has no year test (the delete matches the day in any year
        partition), unlike the day filter used for copying and counting.
        """
        pc = F.col(quote_name(day_column))
        if self.kind == "day":
            return pc == date_lit(self.date)
        if self.kind == "from":
            return pc >= date_lit(self.date)
        return None

    def _filter(self, day_column: str, year_column: str | None, history_floor: str) -> Column:
        pc = F.col(quote_name(day_column))
        if self.kind == "day":
            pred = pc == date_lit(self.date)
            if year_column:
                pred = (F.col(quote_name(year_column)) == F.lit(year_of(self.date))) & pred
            return pred
        if self.kind == "from":
            return pc >= date_lit(self.date)
        return pc >= date_lit(history_floor)


def survivors(predicate: Column) -> Column:
    """Rows a delete with ``predicate`` keeps: only a TRUE match is deleted.

    ``NOT predicate`` would also drop the rows where it is NULL.
    """
    return ~F.coalesce(predicate, F.lit(False))
