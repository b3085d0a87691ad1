"""Text helpers: configured lists (F12) and SQL templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(value: str | None) -> list[str]:
    """a comma list from configuration.

    The whole value is trimmed first; we also trim each item and drop empty items
    (deviation: ``" a, b"`` gives ``["a", "b"]``, never a name with a blank).
    """
    if value is None:
        raise KeyError("a comma separated list is required")
    return [item.strip() for item in value.strip().split(",") if item.strip()]


def split_list_col(col: Column | str) -> Column:
    """F12 on a column: trimmed items of a comma list."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.transform(F.split(F.trim(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def fill_template(sql: str, values: dict[str, str | int]) -> str:
    """replace ``<NAME>`` placeholders, in one pass.

    The statement goes to an ANSI database: strings become quoted literals with
    their quotes doubled and backslashes left alone, integers numbers, so a value
    cannot change the statement. A placeholder inside quotes
    (``source_table = '<SOURCE_TABLE>'``) becomes text of that literal.
    """
    if not values:
        return sql
    name = "<(" + "|".join(re.escape(k) for k in sorted(values, key=len, reverse=True)) + ")>"

    def doubled(key: str) -> str:
        return str(values[key]).replace("'", "''")

    def fill(m: re.Match) -> str:
        if m[1] is None:  # a literal of the template
            return re.sub(name, lambda k: doubled(k[1]), m[0])
        value = values[m[1]]
        return str(int(value)) if isinstance(value, int) else f"'{doubled(m[1])}'"

    return re.sub(f"'(?:[^']|'')*'|{name}", fill, sql)
