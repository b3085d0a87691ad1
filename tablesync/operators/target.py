"""Day-partitioned target tables: append (K1), replace a day (K2) or every day
from a date (K3), create empty (K4), re-read (S4), count (S5), exists (S9).

The target is a catalog table partitioned by ``(year, day)`` (or ``(day)`` when
the source has no year column), so every write and every re-count touches only
the partitions of the slice, never the whole table:

* a write is an ``insertInto`` under *dynamic* partition overwrite: only the days
  present in the slice are swapped, as one commit per write job; a day's replace
  names its year, so only that year's partitions are listed;
* days that the predicate covers but the new slice lacks (T18) are dropped
  afterwards with ``ALTER TABLE .. DROP PARTITION`` - a metadata operation. They are
  noted before the overwrite and found by an anti-join with the partitions that the
  write filled, so a run that stops in between is finished by the next one, and no
  list of partitions is held on the driver;
* a table made here requires a partition filter of whoever reads it through the target;
* rows with a NULL day live in the default partition and are never matched by a
  predicate, so they survive every replace (T1);
* the row count comes from an ``Observation`` on the write itself: one pass over the
  source instead of a count and a write (T14).

The observation sits in the result stage of the write job: above the
``rebalance`` shuffle when there is one, in the only stage when the slice is
written straight from its scan. Spark applies result-task metrics once per
partition even when tasks are retried after an executor loss, so the count stays
exact (tested with injected task failures).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.status import count_text
from tablesync.operators.pending import Note, Notes
from tablesync.operators.predicates import DEFAULT_YEAR_COLUMN
from tablesync.operators.pruning import require_partition_filter
from tablesync.session import dynamic_session, quote_ident, quote_name, sql_string
from tablesync.sources.catalog import TableInfo, describe_table, table_exists

DEFAULT_PARTITION_NAME = "__HIVE_DEFAULT_PARTITION__"
#: Partitions in a drop statement, which are all that the driver holds of the stale ones.
DROP_SPECS_PER_STATEMENT = 500
#: Dropped partitions that a result names; it counts all.
NAMED_DROPS = 1000
#: Table property: reads need a filter on the partition columns.
FILTER_PROPERTY = "tablesync.require.partition.filter"
AQE_KEY = "spark.sql.adaptive.enabled"
SPLIT_KEY = "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"


@dataclass(frozen=True)
class WriteResult:
    """What one observed write wrote, and how many stale partitions went (the first of them by name)."""

    rows: int
    dropped: tuple = ()
    dropped_count: int = 0


def ddl_type(data_type: T.DataType) -> str:
    """A type as DDL text, with nested field names quoted."""
    if isinstance(data_type, T.StructType):
        inner = ", ".join(f"{quote_name(f.name)}: {ddl_type(f.dataType)}" for f in data_type.fields)
        return f"struct<{inner}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{ddl_type(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{ddl_type(data_type.keyType)}, {ddl_type(data_type.valueType)}>"
    return data_type.simpleString()


def _find(names: list[str], wanted: str) -> str | None:
    for name in names:
        if name.lower() == wanted.lower():
            return name
    return None


def _literal(value: object) -> str:
    """A partition value in a DROP PARTITION clause; NULL is the default partition."""
    if value is None:
        return "null"
    text = value.isoformat() if isinstance(value, dt.date) else str(value)
    return text if isinstance(value, int) and not isinstance(value, bool) else sql_string(text)


def _metric(obs: Observation, name: str) -> object:
    """An observed metric; a write whose metrics are missing is not an empty write."""
    got = obs.get
    if name not in got:
        raise RuntimeError(f"the write reported no {name!r}")
    return got[name]


class DayTarget:
    """A target table partitioned by day.

    ``table`` is a catalog name (``db.table``). ``format`` is the file format of
    a newly created table. ``rebalance`` asks AQE to lay the write out by
    partition, splitting hot days over several tasks, so a day is written as few
    files of a sensible size whatever the source layout; switch it off when the
    source is already partitioned by day and the extra shuffle is not wanted.
    ``require_filter`` marks a newly created table: ``read`` and ``count`` of it then
    refuse a predicate that prunes no partition, before any job starts. The mark is a
    property of the table, so it holds for every later target on it.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        day_column: str,
        year_column: str | None = DEFAULT_YEAR_COLUMN,
        format: str = "parquet",
        rebalance: bool = True,
        require_filter: bool = True,
    ):
        self.spark = spark
        self.table = table
        self.day_column = day_column
        self.year_column = year_column
        self.format = format
        self.rebalance = rebalance
        self.require_filter = require_filter
        self._info: TableInfo | None = None

    # ------------------------------------------------------------------ metadata
    def exists(self) -> bool:
        """S9."""
        return table_exists(self.spark, self.table)

    def schema(self) -> T.StructType:
        return self.spark.table(self.table).schema

    def _describe(self) -> TableInfo:
        """Partition columns, properties and location, read once per target
        (none can change while the table exists)."""
        if self._info is None:
            self._info = describe_table(self.spark, self.table)
        return self._info

    def partition_columns(self) -> list[str]:
        return list(self._describe().partition_columns)

    def location(self) -> str:
        return self._describe().location

    def filter_required(self) -> bool:
        """Whether the table demands a partition filter of its readers."""
        return f"{FILTER_PROPERTY}=true" in self._describe().properties

    def _notes(self) -> Notes:
        return Notes(self.spark, self.location())

    def _partition_columns_for(self, schema: T.StructType) -> list[str]:
        names = schema.fieldNames()
        day = _find(names, self.day_column)
        if day is None:
            raise ValueError(f"slice has no day column {self.day_column!r}")
        if not isinstance(schema[day].dataType, T.DateType):
            # A timestamp here would make one partition per distinct instant.
            raise ValueError(
                f"day column {day!r} must be DATE, not {schema[day].dataType.simpleString()}; "
                f"derive it with CAST(<ts> AS DATE)"
            )
        year = _find(names, self.year_column) if self.year_column else None
        return [year, day] if year else [day]

    # ------------------------------------------------------------------ create
    def create_empty(self, schema: T.StructType) -> bool:
        """K4: create the table with this schema and no rows, unless it exists."""
        if self.exists():
            return False
        pcols = self._partition_columns_for(schema)
        # Data columns first, partition columns last (their order in the table).
        fields = [f for f in schema.fields if f.name not in pcols] + [schema[c] for c in pcols]
        cols = ", ".join(f"{quote_name(f.name)} {ddl_type(f.dataType)}" for f in fields)
        parts = ", ".join(quote_name(c) for c in pcols)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {quote_ident(self.table)} ({cols}) USING {self.format} "
            f"PARTITIONED BY ({parts}) OPTIONS ('partitionOverwriteMode' = 'dynamic') "
            f"TBLPROPERTIES ('{FILTER_PROPERTY}' = '{str(self.require_filter).lower()}')"
        )
        return True

    def _new_fields(self, schema: T.StructType) -> list[T.StructField]:
        have = {n.lower() for n in self.schema().fieldNames()}
        return [f for f in schema.fields if f.name.lower() not in have]

    def _evolve(self, schema: T.StructType) -> None:
        """K1 field addition: add the slice's new columns (nullable) to the table."""
        new = self._new_fields(schema)
        pcols = {c.lower() for c in self._partition_columns_for(schema)}
        bad = [f.name for f in new if f.name.lower() in pcols]
        if bad:
            raise ValueError(f"target {self.table} is not partitioned by {bad}")
        cols = ", ".join(f"{quote_name(f.name)} {ddl_type(f.dataType)}" for f in new)
        self.spark.sql(f"ALTER TABLE {quote_ident(self.table)} ADD COLUMNS ({cols})")
        self.spark.catalog.refreshTable(self.table)

    def _prepare(self, df: DataFrame) -> DataFrame:
        """Create or widen the table, then order the slice's columns like the table.

        Columns the slice lacks are written as NULL, as an append of a narrower
        frame into a wider table does. An empty slice does not widen the table (T3);
        whether it is empty is looked up only if there is a column to add.
        """
        if not self.create_empty(df.schema) and self._new_fields(df.schema) and not df.isEmpty():
            self._evolve(df.schema)
        names = df.columns
        out = []
        for f in self.schema().fields:
            src = _find(names, f.name)
            if src is None:
                out.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                out.append(F.col(quote_name(src)).alias(f.name))
        return df.select(*out)

    # ------------------------------------------------------------------ writes
    def _declares_dynamic_overwrite(self) -> bool:
        """Whether the table itself carries the dynamic overwrite option (ours do)."""
        return "partitionOverwriteMode=dynamic" in self._describe().storage

    def _layout(self, df: DataFrame, pcols: list[str], one_day: bool = False) -> DataFrame:
        """Rebalance the write when AQE can keep its partitions to a sensible size.

        One day's rows are rebalanced without a key, so they are cut by bytes alone.
        Several days are rebalanced on the partition columns, if AQE may split a hot
        day. Otherwise a hash shuffle would send a whole hot day to one task, so the
        slice is written straight from its scan splits (sized by bytes, never by key):
        more files, but no task holds more than one split.
        """

        def on(key: str) -> bool:
            return str(self.spark.conf.get(key, "true")).lower() == "true"

        if not self.rebalance or not on(AQE_KEY):
            return df
        if one_day:
            return df.hint("rebalance")
        return df.hint("rebalance", *[F.col(quote_name(c)) for c in pcols]) if on(SPLIT_KEY) else df

    def _observed_write(self, df: DataFrame, overwrite: bool, one_day: bool = False, year: int | None = None) -> WriteResult:
        aligned = self._prepare(df)
        pcols = self.partition_columns()
        aligned = self._layout(aligned, pcols, one_day)
        obs = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        self._insert(aligned, obs, metrics, pcols, overwrite, year)
        return WriteResult(rows=_metric(obs, "rows"))

    def _insert(self, df: DataFrame, obs: Observation, metrics: list[Column], pcols: list[str], overwrite: bool, year: int | None) -> None:
        if not overwrite:
            df.observe(obs, *metrics).write.insertInto(self.table)
        elif not self._declares_dynamic_overwrite():
            self._overwrite_elsewhere(df, obs, metrics)
        elif year is not None and len(pcols) == 2 and _find(pcols, self.year_column or "") == pcols[0]:
            self._overwrite_in_year(df.observe(obs, *metrics), pcols, year)
        else:
            df.observe(obs, *metrics).write.insertInto(self.table, overwrite=True)

    def _overwrite_elsewhere(self, df: DataFrame, obs: Observation, metrics: list[Column]) -> None:
        """Dynamic overwrite of a table that does not declare the mode itself.

        A static overwrite would empty the whole table; never risk it. The write runs in
        a session of its own with the mode set, so no other write is affected.
        """
        session = dynamic_session(self.spark)
        view = f"tsync_{uuid.uuid4().hex}"
        df.createGlobalTempView(view)
        try:
            session.table(f"global_temp.{view}").observe(obs, *metrics).write.insertInto(self.table, overwrite=True)
        finally:
            self.spark.catalog.dropGlobalTempView(view)

    def _overwrite_in_year(self, df: DataFrame, pcols: list[str], year: int) -> None:
        """Dynamic overwrite within one year: only that year's partitions are listed."""
        view = f"tsync_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        cols = ", ".join(quote_name(c) for c in df.columns if c != pcols[0])
        spec = f"{quote_name(pcols[0])} = {int(year)}, {quote_name(pcols[1])}"
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {quote_ident(self.table)} PARTITION ({spec}) SELECT {cols} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def append(self, df: DataFrame) -> WriteResult:
        """K1: add the slice's rows; other rows are untouched."""
        return self._observed_write(df, overwrite=False)

    def replace(self, df: DataFrame, predicate: Column, day: str | None = None, year: int | None = None) -> WriteResult:
        """K2 / K3: afterwards the target holds ``df`` where ``predicate`` is TRUE,
        and its old rows everywhere else.

        An empty slice changes nothing (T3), but what an earlier run left undone is
        finished first. The table must be partitioned by the day column;
        ``predicate`` may only use partition columns. ``day`` (ISO
        date) says the predicate covers that one day, so only that day's
        partitions are listed from the catalog instead of all of them; ``year`` says
        that all rows of ``df`` have that year, so the write lists that year's only.
        """
        note = None
        if self.exists():
            if _find(self.partition_columns(), self.day_column) is None:
                raise ValueError(f"target {self.table} is not partitioned by {self.day_column}")
            self.finish_pending()
            if (open_ones := self._not_surely_filled(predicate, day, year)) is not None:
                note = self._notes().open(open_ones)
        try:
            result = self._observed_write(self._inside(df, predicate, year), overwrite=True, one_day=day is not None, year=year)
        except BaseException:
            if note is not None:
                self._notes().close(note)  # a failed write has replaced nothing
            raise
        if note is None:
            return result
        notes = self._notes()
        if result.rows == 0:
            notes.close(note)
            return result
        notes.commit(note)
        dropped, n = self._drop_stale(notes, note)
        notes.close(note)
        notes.forget_uncommitted()
        return WriteResult(result.rows, dropped, n)

    def finish_pending(self) -> int:
        """Drop what a replace that stopped after its commit had still to drop; the number of partitions."""
        notes, n = self._notes(), 0
        for note in notes.committed():
            n += self._drop_stale(notes, note)[1]
            notes.close(note)
        return n

    def _inside(self, df: DataFrame, predicate: Column, year: int | None) -> DataFrame:
        """Fail the write (before anything is committed) on a row outside the range.

        Such a row would overwrite a day the predicate does not cover and lose that
        day's other rows, unlike delete-then-append. Rows are never dropped.
        """
        day = _find(df.columns, self.day_column)
        if day is None:
            return df  # reported by the write itself
        inside = F.coalesce(predicate, F.lit(False))
        its_year = _find(df.columns, self.year_column) if self.year_column else None
        if year is not None and its_year is not None:
            inside = inside & F.col(quote_name(its_year)).eqNullSafe(F.lit(int(year)))
        checked = F.when(inside, F.col(quote_name(day))).otherwise(
            F.raise_error(F.lit(f"row outside the replaced range of {self.table}"))
        )
        return df.withColumn(day, checked)

    def _partition_frame(self, day: str | None = None) -> DataFrame:
        """The table's partitions as typed columns, from catalog metadata only."""
        schema = self.schema()
        pcols = self.partition_columns()
        kv = F.str_to_map(F.col("partition"), F.lit("/"), F.lit("="))
        cols = []
        for c in pcols:
            raw = kv[F.lit(c)]  # escaped like a path: %3A for a colon; a plus is a plus
            text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
            value = F.when(raw == F.lit(DEFAULT_PARTITION_NAME), F.lit(None)).otherwise(text)
            cols.append(value.cast(schema[c].dataType).alias(c))
        spec = ""
        if day is not None:
            spec = f" PARTITION ({quote_name(_find(pcols, self.day_column))} = {sql_string(day)})"
        return self.spark.sql(f"SHOW PARTITIONS {quote_ident(self.table)}{spec}").select(*cols)

    def _not_surely_filled(self, predicate: Column, day: str | None, year: int | None) -> DataFrame | None:
        """Partitions in the replaced range that the slice may leave unfilled; None if there can be none.

        Rows of one day and a known year fill one partition, which needs no note.
        """
        pcols = self.partition_columns()
        its_day, its_year = _find(pcols, self.day_column), _find(pcols, self.year_column or "")
        if day is not None and pcols == [its_day]:
            return None
        found = self._partition_frame(day).where(predicate)
        if day is not None and year is not None and sorted(pcols) == sorted([its_day, its_year or ""]):
            found = found.where(~F.col(quote_name(its_year)).eqNullSafe(F.lit(int(year))))
        return found

    def _filled(self, note: Note) -> DataFrame:
        """Partitions among the noted days that have files younger than the note."""
        pcols = self.partition_columns()
        day = quote_name(_find(pcols, self.day_column))
        low, high = note.partitions.agg(F.min(day), F.max(day)).first()
        rows = self._frame()
        if low is not None:
            rows = rows.where(F.col(day).between(F.lit(low), F.lit(high)))
        young = F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(note.since))
        return rows.where(young).select(*[F.col(quote_name(c)) for c in pcols]).distinct()

    def _drop_stale(self, notes: Notes, note: Note) -> tuple[tuple, int]:
        """Drop the noted partitions that the write did not fill, a statement's worth at a time."""
        pcols = self.partition_columns()
        stale = notes.stale(note, self._filled(note), pcols)
        named, n, chunk = [], 0, []
        for row in stale.toLocalIterator():
            if n < NAMED_DROPS:
                named.append(tuple(row[c] for c in pcols))
            n += 1
            chunk.append(row)
            if len(chunk) == DROP_SPECS_PER_STATEMENT:
                self._drop(chunk)
                chunk = []
        if chunk:
            self._drop(chunk)
        if n:
            self._check_dropped(stale, pcols)
        return tuple(named), n

    def _drop(self, partitions: Iterable[Row]) -> None:
        pcols = self.partition_columns()
        specs = (", ".join(f"{quote_name(c)}={_literal(row[c])}" for c in pcols) for row in partitions)
        chunk = ", ".join(f"PARTITION ({spec})" for spec in specs)
        self.spark.sql(f"ALTER TABLE {quote_ident(self.table)} DROP IF EXISTS {chunk}")

    def _check_dropped(self, stale: DataFrame, pcols: list[str]) -> None:
        self.spark.catalog.refreshTable(self.table)
        left = stale.select(*[quote_name(c) for c in pcols]).intersect(self._partition_frame().select(*[quote_name(c) for c in pcols]))
        if still := left.take(5):
            raise RuntimeError(f"partitions of {self.table} could not be dropped: {[tuple(r) for r in still]}")

    # ------------------------------------------------------------------ reads
    def _frame(self) -> DataFrame:
        """The whole target, unchecked."""
        return self.spark.table(self.table)

    def _checked(self, df: DataFrame) -> DataFrame:
        return require_partition_filter(df, self.table) if self.filter_required() else df

    def read(self, predicate: Column) -> DataFrame:
        """Rows of the target under a required partition filter (K1).

        Raises ``UnfilteredRead`` before any job if the table requires a filter and the plan
        of the read prunes no partition.
        """
        return self._checked(self._frame().where(predicate))

    def count_frame(self, predicate: Column) -> DataFrame:
        """S5 / A2 as a one-row frame ``size string``; NULL when the table is missing."""
        if not self.exists():
            return self.spark.range(1).select(F.lit(None).cast("string").alias("size"))
        return self._checked(self._frame().where(predicate).agg(count_text(F.count(F.lit(1))).alias("size")))

    def count(self, predicate: Column) -> str | None:
        """The count as text, ``None`` when the table is missing."""
        return self.count_frame(predicate).collect()[0]["size"]
