"""Helpers of the two vector operators: valid vectors, classes of equal ones, blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors that are not null, empty or zero and hold finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & ~bad & some, F.lit(False))


def same_vector(*cols: str) -> Column:
    """A 128-bit name that rows of equal vectors (and other equal columns) share; -0.0 equals 0.0."""
    return F.concat(F.hex(F.xxhash64(*cols)), F.lit(":"), F.hex(F.xxhash64(F.lit(1), *cols)))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of a group's vectors in double precision."""
    return np.array(vectors.tolist(), dtype=np.float64)


def in_blocks(rows: DataFrame, key: list[str], by: str, most: int) -> DataFrame:
    """Adds columns one, two: the pairs of a key's blocks that a row takes part in.

    A key of more than ``most`` rows is cut into blocks by a hash of ``by``, and each pair
    of blocks, a block with itself included, is a group of its own. The block that a row
    is of is in column own.
    """
    sizes = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_blocks"))
    rows = rows.join(sizes, key)
    rows = rows.withColumn("own", F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.withColumns({"one": F.least("own", "_other"), "two": F.greatest("own", "_other")}).drop("_blocks", "_other")
