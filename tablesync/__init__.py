"""tablesync: copy date slices of tables into day-partitioned targets and prove
the copy right, as plain Spark batch jobs."""

from tablesync.functions.dates import Clock, FixedClock, date_key
from tablesync.functions.message import status_messages, utf8_payload
from tablesync.functions.runtime import runtime_text
from tablesync.functions.status import pass_fail
from tablesync.operators.path_target import PathTarget
from tablesync.operators.predicates import SliceSpec, survivors
from tablesync.operators.pruning import UnfilteredRead
from tablesync.operators.report import REPORT_SCHEMA, ReportRow, append_process_report, append_report, process_rows, report_frame
from tablesync.operators.target import DayTarget, WriteResult
from tablesync.plans.notify import lookup_all, lookup_control
from tablesync.plans.relay import export_csv, relay_files
from tablesync.plans.replicate import Notify, Replication, ReplicationFailed, replicate, replicate_and_notify
from tablesync.plans.runmode import RunMode, resolve_run_mode
from tablesync.plans.sizes import catalog_size_report, size_report, size_total
from tablesync.sources.catalog import file_sizes, list_tables
from tablesync.sources.delimited import read_delimited
from tablesync.sources.documents import read_json_documents
from tablesync.sources.jdbc import read_jdbc_query, read_jdbc_table
from tablesync.sources.slices import read_slice, source_table
from tablesync.streaming.publish import MessageSink

__all__ = [
    "REPORT_SCHEMA",
    "Clock",
    "DayTarget",
    "FixedClock",
    "MessageSink",
    "Notify",
    "PathTarget",
    "Replication",
    "ReplicationFailed",
    "ReportRow",
    "RunMode",
    "SliceSpec",
    "UnfilteredRead",
    "WriteResult",
    "append_process_report",
    "append_report",
    "catalog_size_report",
    "date_key",
    "export_csv",
    "file_sizes",
    "list_tables",
    "lookup_all",
    "lookup_control",
    "pass_fail",
    "process_rows",
    "read_delimited",
    "read_jdbc_query",
    "read_jdbc_table",
    "read_json_documents",
    "read_slice",
    "relay_files",
    "replicate",
    "replicate_and_notify",
    "report_frame",
    "resolve_run_mode",
    "runtime_text",
    "size_report",
    "size_total",
    "source_table",
    "status_messages",
    "survivors",
    "utf8_payload",
]
