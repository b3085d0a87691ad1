"""Replication jobs: batch (C2), replicate-and-notify (C3), failure isolation (C4).

The driver loops over table names only (one at a time, or ``parallelism`` at
once); every step of a table is a Spark job: the observed slice write, the
re-count, the report append. One table's failure becomes a ``Fail`` row with the
error text and the other tables still run. With ``recount="together"`` the re-counts of
all tables are one job after the writes: a union of the targets' slices, one grouped
count, and a full join with the writers' counts.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.dates import Clock, date_key_of
from tablesync.functions.message import status_messages
from tablesync.functions.status import FAIL, ZERO, error_text, verdict
from tablesync.operators.predicates import DEFAULT_YEAR_COLUMN, SliceSpec
from tablesync.operators.report import (
    ReportRow,
    append_process_report,
    append_report,
    process_rows,
    report_frame,
)
from tablesync.operators.path_target import PathTarget
from tablesync.operators.target import DayTarget
from tablesync.plans.notify import last_row, lookup_control
from tablesync.plans.runmode import RunMode
from tablesync.sources.catalog import partition_columns
from tablesync.sources.slices import read_slice, resolve_column, source_table
from tablesync.streaming.publish import MessageSink

log = logging.getLogger("tablesync")

# Fixed value: schedulers scan the job log for this line; keep its format.
LOADED_LINE = "Successfully Loaded Table:{table}"

#: When targets are re-counted: each after its write, or all in one job after all writes.
EACH, TOGETHER = "each", "together"

# Appends to destinations shared by all tables (report tables, message folder) run
# one at a time: concurrent appends to one path in one application would share
# the output committer's temporary folder.
_SHARED_WRITES = threading.Lock()


class ReplicationFailed(RuntimeError):
    """Raised by ``raise_on_fail=True`` after all tables ran, with the report."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"tables failed: {', '.join(failed)}")
        self.report = report
        self.failed = failed


ControlReader = Callable[[str, str, int], DataFrame]


@dataclass
class Notify:
    """What the notify job needs beyond replication.

    ``control`` is the control table (filtered per table by :func:`lookup_control`)
    or a reader ``(table, database, yyyymmdd) -> DataFrame`` that returns the wanted
    rows, such as a filled SQL template read over JDBC: all of them are reported, and
    the last one (:func:`last_row`) is published.
    """

    control: DataFrame | ControlReader
    process_table: str | None = None
    sink: MessageSink | None = None


@dataclass
class Replication:
    """One job's settings.

    ``load_source(table)`` gives the source frame of a table (default: the
    catalog table ``source_database.table``). Targets are
    ``target_database.table``, or, if ``target_path`` is given, the folders
    ``target_path/table``. ``database_name`` is what the report records as
    the source database.
    """

    spark: SparkSession
    tables: list[str]
    target_database: str
    day_column: str
    run_mode: RunMode
    source_database: str | None = None
    load_source: Callable[[str], DataFrame] | None = None
    database_name: str | None = None
    year_column: str | None = DEFAULT_YEAR_COLUMN
    report_table: str | None = None
    clock: Clock = field(default_factory=Clock)
    format: str = "parquet"
    rebalance: bool | None = None
    parallelism: int = 1
    report_every: int = 1
    target_path: str | None = None
    recount: str = EACH

    def __post_init__(self):
        if self.recount not in (EACH, TOGETHER):
            raise ValueError(f"recount is {EACH!r} or {TOGETHER!r}, not {self.recount!r}")

    def source(self, table: str) -> DataFrame:
        if self.load_source is not None:
            return self.load_source(table)
        if not self.source_database:
            raise ValueError("either source_database or load_source is required")
        return source_table(self.spark, self.source_database, table)

    def source_laid_out_by_day(self, table: str) -> bool:
        """Whether the source is a catalog table partitioned by the day column.

        Its scan splits then come from one day's files each, so the slice can be
        written straight from the scan: no shuffle, and a hot day is already
        spread over as many tasks as it has splits.
        """
        if self.load_source is not None or not self.source_database:
            return False
        pcols = partition_columns(self.spark, f"{self.source_database}.{table}")
        return any(c.lower() == self.day_column.lower() for c in pcols)

    def target(self, table: str) -> DayTarget:
        """``rebalance=None`` (auto): shuffle on the partition columns unless the
        source is already laid out by day."""
        rebalance = self.rebalance
        if rebalance is None:
            rebalance = not self.source_laid_out_by_day(table)
        if self.target_path is not None:
            path = f"{self.target_path.rstrip('/')}/{table}"
            return PathTarget(self.spark, path, self.day_column, self.year_column, format=self.format, rebalance=rebalance)
        return DayTarget(
            self.spark,
            f"{self.target_database}.{table}",
            self.day_column,
            self.year_column,
            format=self.format,
            rebalance=rebalance,
        )

    @property
    def db_name(self) -> str:
        return self.database_name or self.source_database or ""


@dataclass
class _Copy:
    """One table's way through a run: its writer's count, and what is to be re-counted."""

    table: str
    start: object
    counts: dict = field(default_factory=lambda: {"source": ZERO, "target": ZERO})
    target: DayTarget | None = None
    written: Column | None = None  # the rows to re-count; None where nothing was written
    error: BaseException | None = None


def _copy_table(job: Replication, spec: SliceSpec, create_empty: bool, copy: _Copy) -> None:
    """Slice and write one table."""
    table = copy.table
    target = job.target(table)
    source = job.source(table)
    sliced = read_slice(source, spec, job.day_column, job.year_column)
    if not target.exists() and sliced.isEmpty():
        # Nothing to copy into a table that is not there yet.
        if create_empty:
            target.create_empty(sliced.schema)  # K4
        rows = 0
    elif spec.appends:
        rows = target.append(sliced).rows  # K1
    else:
        day = year = None
        if spec.kind == "day":
            day = spec.date
            if resolve_column(source, job.year_column):
                year = int(day.split("-")[0])  # the day's slice holds this year only (P2)
        rows = target.replace(sliced, spec.replace_predicate(job.day_column), day, year).rows  # K2 / K3
    copy.counts["source"] = str(rows)
    if rows:  # an empty slice changes nothing and is not re-counted (T3)
        copy.target = target
        copy.written = spec.target_filter(resolve_column(source, job.day_column) or job.day_column, resolve_column(source, job.year_column))


def _recount(copy: _Copy) -> None:
    if copy.written is None:
        return
    found = copy.target.count(copy.written)
    if found is None:
        raise RuntimeError(f"target {copy.target.table} not found after the write")
    copy.counts["target"] = found


def _recount_together(job: Replication, copies: list[_Copy]) -> None:
    """A2 for all tables in one job; a table that cannot be read is counted, and fails, alone (C4)."""
    parts = []
    for k, copy in enumerate(copies):
        if copy.written is None or copy.error is not None:
            continue
        try:
            parts.append(copy.target.read(copy.written).select(F.lit(k).alias("copy")))
        except Exception as exc:
            copy.error = exc
    if not parts:
        return
    while len(parts) > 1:  # pairwise, so no plan is analysed again for every table
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    found = parts[0].groupBy("copy").agg(F.count(F.lit(1)).alias("found"))
    sources = [(k, int(c.counts["source"])) for k, c in enumerate(copies) if c.written is not None and c.error is None]
    written = job.spark.createDataFrame(sources, "copy int, written long")
    try:
        rows = written.join(found, "copy", "full").collect()  # one row a table
    except Exception as exc:
        log.error("re-counting all tables at once failed, counting each: %s", exc)
        for copy in copies:
            if copy.error is None:
                try:
                    _recount(copy)
                except Exception as alone:
                    copy.error = alone
        return
    for r in rows:
        copies[r["copy"]].counts["target"] = str(r["found"] or 0)


class _ReportBuffer:
    """Report rows waiting to be appended.

    ``report_every=1`` appends each table's row as soon as the table is done (a
    crash loses nothing already reported); a larger value appends rows in
    groups, so a run over thousands of tables writes a few report files per day
    instead of one per table. Whatever is left is appended at the end of the job.
    """

    def __init__(self, job: Replication):
        self.job = job
        self.rows: list[ReportRow] = []
        self.lock = threading.Lock()

    def add(self, rows: list[ReportRow]) -> None:
        with self.lock:
            self.rows.extend(rows)
            if len(self.rows) < max(1, self.job.report_every):
                return
            pending, self.rows = self.rows, []
        _append_report(self.job, pending)

    def flush(self) -> None:
        with self.lock:
            pending, self.rows = self.rows, []
        if pending:
            _append_report(self.job, pending)


def _written(job: Replication, spec: SliceSpec, create_empty: bool, table: str) -> _Copy:
    copy = _Copy(table, job.clock.now())
    try:
        _copy_table(job, spec, create_empty, copy)
        if job.recount == EACH:
            _recount(copy)
    except Exception as exc:  # C4: the table fails, the job goes on
        copy.error = exc
    return copy


def _table_rows(job: Replication, spec: SliceSpec, notify: Notify | None, load_date, report: _ReportBuffer, copy: _Copy) -> list[ReportRow]:
    """The report of one table; one row, two if the notify step fails."""
    table, counts, start = copy.table, copy.counts, copy.start
    status, details = FAIL, ""
    if copy.error is None:
        status = verdict(counts["source"], counts["target"])
        if status != FAIL:
            log.info(LOADED_LINE.format(table=table))
    else:
        log.error("table %s failed: %s", table, copy.error)
        details = error_text(copy.error)
    row = ReportRow(table, counts["source"], counts["target"], status, job.db_name, load_date, start, job.clock.now(), details)
    rows = [row]
    report.add([row])
    if notify is not None and not spec.appends and not details:
        try:
            _notify(job, notify, table, status)
        except Exception as exc:  # T8: a second Fail row for the same table
            log.error("notify for %s failed: %s", table, exc)
            late = ReportRow(table, counts["source"], counts["target"], FAIL, job.db_name, load_date, start, job.clock.now(), error_text(exc))
            rows.append(late)
            report.add([late])
    return rows


def _run(job: Replication, spec: SliceSpec, notify: Notify | None, create_empty: bool) -> list[ReportRow]:
    """Run every table; with ``parallelism > 1`` several tables run at once.

    A daily run is many small slices: running them side by side keeps a large
    cluster busy instead of waiting on one small job after another. Report rows
    keep the order of the table list.
    """
    load_date = job.clock.now().date()  # taken once per job (T10)
    report = _ReportBuffer(job)

    def write(table: str) -> _Copy:
        return _written(job, spec, create_empty, table)

    def finish(copy: _Copy) -> list[ReportRow]:
        return _table_rows(job, spec, notify, load_date, report, copy)

    def each(step: Callable, items: list) -> list:
        # A table named twice runs twice, one run after the other (two concurrent
        # writers of one target would conflict).
        repeated = len(set(job.tables)) != len(job.tables)
        if job.parallelism <= 1 or len(items) <= 1 or repeated:
            return [step(x) for x in items]
        with ThreadPoolExecutor(max_workers=job.parallelism, thread_name_prefix="tablesync") as pool:
            return list(pool.map(step, items))

    try:
        if job.recount == TOGETHER:
            copies = each(write, job.tables)
            _recount_together(job, copies)
            per_table = each(finish, copies)
        else:
            per_table = each(lambda table: finish(write(table)), job.tables)
    finally:
        report.flush()
    return [r for rows in per_table for r in rows]


def _append_report(job: Replication, rows: list[ReportRow]) -> None:
    if not job.report_table:
        return
    try:
        with _SHARED_WRITES:
            append_report(job.spark, report_frame(job.spark, rows), job.report_table)
    except Exception as exc:
        log.error("report append failed for %s: %s", [r.table_name for r in rows], exc)


def _notify(job: Replication, notify: Notify, table: str, status: str) -> None:
    """C3 tail: every control row -> process report (K7), the last one -> message (L2, K8)."""
    key = date_key_of(job.run_mode.date)
    if isinstance(notify.control, DataFrame):
        found = lookup_control(notify.control, table, job.db_name, key)
    else:
        found = notify.control(table, job.db_name, key)
    found = found.persist()  # one read of the control source for the three uses below
    try:
        if found.isEmpty():  # A4
            return
        with _SHARED_WRITES:
            if notify.process_table:
                append_process_report(job.spark, process_rows(found, job.db_name, table, status, job.run_mode.date), notify.process_table)
            if notify.sink is not None:
                notify.sink.publish(status_messages(last_row(found), job.db_name, table, status))
    finally:
        found.unpersist()


def _finish(job: Replication, rows: list[ReportRow], raise_on_fail: bool) -> DataFrame:
    report = report_frame(job.spark, rows)
    failed = [r.table_name for r in rows if r.count_result == FAIL]
    if raise_on_fail and failed:
        raise ReplicationFailed(report, failed)
    return report


def replicate(job: Replication, raise_on_fail: bool = False) -> DataFrame:
    """Copy each table's day (or its history) and report Pass/Fail per table.

    Day run: replace that day in the target (K2). History run: append every
    dated row (K1); running it twice doubles the target and reports ``Fail``.
    """
    return _finish(job, _run(job, job.run_mode.day_slice(), None, create_empty=False), raise_on_fail)


def replicate_and_notify(job: Replication, notify: Notify | None = None, raise_on_fail: bool = False) -> DataFrame:
    """Copy every day from the run date (replacing them, K3), create an empty
    target for an empty slice (K4), and for a dated run look up the control row,
    append the process report and publish the status message (skipped when
    ``notify`` is None)."""
    return _finish(job, _run(job, job.run_mode.open_slice(), notify, create_empty=True), raise_on_fail)
