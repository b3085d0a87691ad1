"""Unit conversion for the size report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: decimal gigabytes, bytes * 0.000000001.
BYTES_TO_GB = 0.000000001


def bytes_to_gb(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double") * F.lit(BYTES_TO_GB)
