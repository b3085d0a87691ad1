"""Required partition filter (K1, S4): a read that prunes no partition is refused.

The check looks at the plan that Spark made of the read, so it sees what the optimiser saw:
a predicate that folds to TRUE, or that only tests data columns, prunes nothing, however it
is written; one that folds to FALSE reads nothing and is fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


class UnfilteredRead(ValueError):
    """A read or count of a table that requires a partition filter has none."""


def unpruned_scans(df: DataFrame) -> list[str]:
    """Scans of partitioned files in the plan of ``df`` that no partition filter narrows.

    A bare IS NOT NULL is no filter. Planning starts no job for a scan without a filter;
    for one with a filter it lists the partitions that the read needs anyway.
    """
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    found = []
    for k in range(leaves.size()):
        scan = leaves.apply(k)
        if scan.getClass().getSimpleName() != "FileSourceScanExec" or scan.relation().partitionSchema().isEmpty():
            continue
        filters = scan.partitionFilters()
        kinds = [filters.apply(i).getClass().getSimpleName() for i in range(filters.size())]
        if all(kind == "IsNotNull" for kind in kinds):
            found.append(scan.relation().partitionSchema().simpleString())
    return found


def require_partition_filter(df: DataFrame, table: str) -> DataFrame:
    """``df`` itself, or an error if it scans all partitions of ``table``."""
    if unpruned := unpruned_scans(df):
        raise UnfilteredRead(f"{table} requires a filter on its partition columns: {', '.join(unpruned)}")
    return df
