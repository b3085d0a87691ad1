"""Configuration-driven jobs, for ``spark-submit``.

    spark-submit --conf spark.tablesync.tables=a,b ... -m tablesync.plans.jobs batch

Sub-commands: ``batch`` (C2), ``notify`` (C3), ``relay`` (C5), ``sizes`` (C6).
Settings are read from the session configuration under ``spark.tablesync.``.
The process exits with status 1 when a table or file failed and
``spark.tablesync.fail.exit`` is true (the original never changed its exit code).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.text import split_list
from tablesync.plans.relay import relay_files
from tablesync.plans.replicate import EACH, Notify, Replication, replicate, replicate_and_notify
from tablesync.plans.runmode import resolve_run_mode
from tablesync.plans.sizes import catalog_size_report, size_total
from tablesync.sources.catalog import list_tables
from tablesync.sources.delimited import PIPE
from tablesync.sources.jdbc import read_jdbc_query, read_jdbc_table
from tablesync.streaming.publish import MessageSink

PREFIX = "spark.tablesync."


class Settings:
    def __init__(self, spark: SparkSession):
        self.conf = spark.conf

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.conf.get(PREFIX + key, default)

    def require(self, key: str) -> str:
        value = self.get(key)
        if value is None or value == "":
            raise KeyError(f"missing setting {PREFIX}{key}")
        return value

    def flag(self, key: str, default: bool) -> bool:
        return str(self.get(key, str(default))).strip().lower() in ("1", "true", "yes")

    def options(self, key: str) -> dict[str, str]:
        """All ``spark.tablesync.<key>.<name>`` settings as ``{name: value}``."""
        prefix = PREFIX + key + "."
        return {k[len(prefix):]: v for k, v in self.conf.getAll.items() if k.startswith(prefix)}


def replication_from_conf(spark: SparkSession) -> Replication:
    s = Settings(spark)
    source_db = s.require("source.database")
    return Replication(
        spark,
        tables=list_tables(spark, source_db, s.require("tables")),
        target_database=s.get("target.database", "") if s.get("target.path") else s.require("target.database"),
        day_column=s.require("day.column"),
        run_mode=resolve_run_mode(s.get("run.date")),
        source_database=source_db,
        year_column=s.get("year.column", "cda_year") or None,
        report_table=s.get("report.table"),
        format=s.get("target.format", "parquet"),
        rebalance=None if s.get("rebalance", "auto") == "auto" else s.flag("rebalance", True),
        parallelism=int(s.get("parallelism", "1")),
        report_every=int(s.get("report.every", "1")),
        target_path=s.get("target.path"),
        recount=s.get("recount", EACH),
    )


def notify_from_conf(spark: SparkSession) -> Notify:
    s = Settings(spark)
    url = s.require("control.url")
    user, password = s.get("control.user"), s.get("control.password")
    template = s.get("control.query")
    if template:

        def control(table: str, database: str, key: int) -> DataFrame:
            values = {"SOURCE_TABLE": table, "TARGET_DB": database, "CDATE": key}
            return read_jdbc_query(spark, url, template, values, user, password)

    else:
        control = read_jdbc_table(spark, url, s.require("control.table"), user, password)
    sink = None
    fmt = s.get("publish.format")
    if fmt:
        sink = MessageSink(fmt, s.get("publish.path"), s.get("publish.topic"), s.options("publish.option"))
    return Notify(control, process_table=s.get("process.table"), sink=sink)


def run_batch(spark: SparkSession) -> DataFrame:
    return replicate(replication_from_conf(spark))


def run_notify(spark: SparkSession) -> DataFrame:
    return replicate_and_notify(replication_from_conf(spark), notify_from_conf(spark))


def run_relay(spark: SparkSession) -> DataFrame:
    s = Settings(spark)
    return relay_files(
        spark,
        split_list(s.require("relay.files")),
        s.require("relay.output"),
        sep=s.get("relay.sep", PIPE),
        infer=s.flag("relay.infer", True),
        parallelism=int(s.get("relay.parallelism", "1")),
    )


def run_sizes(spark: SparkSession) -> DataFrame:
    s = Settings(spark)
    report = catalog_size_report(spark, s.require("sizes.database"), s.require("sizes.tables"))
    return report


COMMANDS = {"batch": run_batch, "notify": run_notify, "relay": run_relay, "sizes": run_sizes}


def main(argv: list[str]) -> int:
    if len(argv) != 1 or argv[0] not in COMMANDS:
        print(f"usage: -m tablesync.plans.jobs {{{'|'.join(COMMANDS)}}}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.getOrCreate()
    result = COMMANDS[argv[0]](spark)
    result.show(truncate=False)
    if argv[0] == "sizes":
        size_total(result).show(truncate=False)
        return 0
    failed = result.where("count_result = 'Fail'") if "count_result" in result.columns else result.where("NOT ok")
    if Settings(spark).flag("fail.exit", False) and not failed.isEmpty():
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
