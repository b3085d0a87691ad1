"""Status messages (F9) and their UTF-8 payload.

A message is the text Python's ``json.dumps`` gives for a dict of strings whose
values are ``str(value)`` of each control-row field, followed by the three run
literals. Consumers parse that text, so it is rebuilt exactly, JVM-side:

* separators ``", "`` and ``": "``, keys in insertion order; a literal whose
  name equals a control column overwrites that value in place (dict semantics);
* NULL is ``"None"``; booleans ``"True"``/``"False"``;
* timestamps as Python prints them: ``YYYY-MM-DD HH:MM:SS`` plus ``.ffffff``
  only when the fraction is not zero;
* strings are JSON-quoted with non-ASCII, control characters and DEL escaped as
  ``\\uXXXX`` in lower-case hex, as Python does.

Floating point values take Python's ``repr`` through a vectorised pandas UDF:
its shortest round-trip text cannot be rebuilt from Spark's own formatting.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import quote_name

NONE_TEXT = "None"

_TO_JSON_OPTIONS = {"writeNonAsciiCharacterAsCodePoint": "true"}
# Jackson writes the hex digits of a \uXXXX escape in upper case. Only used on text
# without raw backslashes, where every backslash begins an escape.
_HEX_IN_ESCAPE = r"(?<=\\u[0-9a-fA-F]{0,3})"


def _python_float_text():
    """A vectorised ``repr`` of floats. Built as a nested function so Spark ships
    it to the Python workers by value: they need not import this package."""

    def text(values: pd.Series) -> pd.Series:
        # NULL arrives as NaN; callers decide NULL before this helper runs.
        return values.map(lambda v: repr(float(v)))

    return F.pandas_udf(text, T.StringType())


def python_str(col: Column | str, data_type: T.DataType) -> Column:
    """``str(value)`` of a collected field, NULL as ``"None"``."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        frac = F.date_format(c, "SSSSSS")
        text = F.when(frac == F.lit("000000"), whole).otherwise(F.concat(whole, F.lit("."), frac))
    elif isinstance(data_type, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(data_type, T.BooleanType):
        text = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(c.isNull(), F.lit(NONE_TEXT)).otherwise(_python_float_text()(c.cast("double")))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NONE_TEXT))


def json_quote(col: Column | str) -> Column:
    """``json.dumps(text)`` of a non-null string column (ASCII-only output).

    The text is cut at its backslashes and each piece is encoded alone, so an escape
    that the encoding makes can't be confused with one that the text spells.
    """
    c = F.col(col) if isinstance(col, str) else col
    pieces = F.transform(F.split(c, r"\\", -1), _json_piece)
    return F.concat(F.lit('"'), F.array_join(pieces, "\\\\"), F.lit('"'))


def _json_piece(piece: Column) -> Column:
    """The inside of the JSON string of a text without backslashes."""
    encoded = F.to_json(F.named_struct(F.lit("v"), piece), _TO_JSON_OPTIONS)
    quoted = F.regexp_extract(encoded, r'^\{"v":"(.*)"\}$', 1)
    # Python also escapes DEL (0x7f), which Jackson leaves as it is.
    quoted = F.regexp_replace(quoted, "\x7f", r"\\u007f")
    for upper in "ABCDEF":
        quoted = F.regexp_replace(quoted, _HEX_IN_ESCAPE + upper, upper.lower())
    return quoted


def json_object(pairs: list[tuple[str, Column]]) -> Column:
    """A JSON object text with Python's separators from (key, text column) pairs."""
    parts: list[Column] = [F.lit("{")]
    for i, (key, value) in enumerate(pairs):
        prefix = ("" if i == 0 else ", ") + json.dumps(key) + ": "
        parts.append(F.lit(prefix))
        parts.append(json_quote(value))
    parts.append(F.lit("}"))
    return F.concat(*parts)


def message_column(
    control: DataFrame,
    source_system: Column | str,
    table_name: Column | str,
    count_result: Column | str,
    fields: list[str] | None = None,
) -> Column:
    """the message of each control row plus the three run values.

    The run values may be plain strings (one run) or columns (many runs at once).
    ``fields`` picks the control columns that go into the message (default: all).
    """
    pairs: dict[str, Column] = {}
    chosen = control.schema.fields if fields is None else [control.schema[f] for f in fields]
    for field in chosen:
        pairs[field.name] = python_str(F.col(quote_name(field.name)), field.dataType)
    for key, value in (
        ("source_system", source_system),
        ("table_name", table_name),
        ("count_result", count_result),
    ):
        v = value if isinstance(value, Column) else F.lit(value)
        pairs[key] = F.coalesce(v.cast("string"), F.lit(NONE_TEXT))
    return json_object(list(pairs.items()))


def status_messages(
    control: DataFrame,
    source_system: Column | str,
    table_name: Column | str,
    count_result: Column | str,
    fields: list[str] | None = None,
) -> DataFrame:
    """One ``value`` string per control row."""
    return control.select(message_column(control, source_system, table_name, count_result, fields).alias("value"))


def utf8_payload(col: Column | str = "value") -> Column:
    """the message bytes as published."""
    c = F.col(col) if isinstance(col, str) else col
    return F.encode(c, "UTF-8")
