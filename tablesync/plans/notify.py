"""Control-row lookup for the notify job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import quote_name

# The control table's key and the columns a lookup returns.
CONTROL_KEY = ("source_table", "target_db", "cda_date")
CONTROL_COLUMNS = ("business_ts", "delivery_ts")


def lookup_control(
    control: DataFrame,
    table: str,
    database: str,
    date_key: int,
    columns: tuple[str, ...] = CONTROL_COLUMNS,
) -> DataFrame:
    """P8 + L1: the control row of one (table, database, day), at most one row.

    Equality filters reach the source (a JDBC query or a Parquet scan). When
    several rows match, the newest wins (``business_ts`` then ``delivery_ts``,
    NULL last): a deterministic choice where the original took any row.
    """
    src, db, day = CONTROL_KEY
    pred = (F.col(src) == F.lit(table)) & (F.col(db) == F.lit(database)) & (F.col(day) == F.lit(date_key))
    order = [F.col(c).desc_nulls_last() for c in columns]
    return control.where(pred).select(*columns).orderBy(*order).limit(1)


def lookup_all(control: DataFrame, columns: tuple[str, ...] = CONTROL_COLUMNS) -> DataFrame:
    """L1 for every key at once: one row per (table, database, day).

    The same choice as :func:`lookup_control` (newest first, NULL last, column
    by column), built from plain ``max`` / ``max_by`` aggregates, one stage per
    column from the last to the first:

    * per key and leading values, the newest value of the last column;
    * then, per key and fewer leading values, the row with the newest value of
      the next column (rows are unique on it by now); if that column is NULL
      everywhere, only one row is left and it is taken as it is.

    Every stage is a partial aggregate, combined map-side, so a key holding a
    large share of the rows costs no skew; on fixed-width columns (the control
    timestamps) every stage is a hash aggregate.
    """
    keys = list(CONTROL_KEY)
    cols = list(columns)
    picked = control.groupBy(*keys, *cols[:-1]).agg(F.max(cols[-1]).alias(cols[-1]))
    for j in range(len(cols) - 2, -1, -1):
        lead, rest = cols[j], cols[j + 1 :]
        newest = F.max(lead)
        others = [F.when(newest.isNull(), F.max(c)).otherwise(F.max_by(c, lead)).alias(c) for c in rest]
        picked = picked.groupBy(*keys, *cols[:j]).agg(newest.alias(lead), *others)
    return picked.select(*keys, *cols)


def last_row(rows: DataFrame) -> DataFrame:
    """L2: the row that becomes the message, of all control rows that were found.

    The last one in ascending order of its columns, from the first to the last column,
    NULL first: among control rows that is the newest. Columns that have no order (maps)
    don't take part. An aggregate, so the rows never meet on the driver; none for none.
    """
    ordered = [F.col(quote_name(f.name)) for f in rows.schema.fields if not _unordered(f.dataType)]
    whole = F.struct(*[F.col(quote_name(c)) for c in rows.columns])
    if not ordered:
        return rows.limit(1)
    last = rows.agg(F.max_by(whole, F.struct(*ordered)).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 0")
    return last.select(*[F.col("last")[c].alias(c) for c in rows.columns])


def _unordered(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return any(_unordered(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _unordered(data_type.elementType)
    return isinstance(data_type, T.MapType | T.VariantType)
