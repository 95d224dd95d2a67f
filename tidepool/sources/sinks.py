"""Sinks: partitioned writes, dynamic partition overwrite, predicate overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite",
                      max_records_per_file: int | None = None) -> str:
    """Partitioned parquet write; rows are rebalanced by the partition columns first,
    so each task writes few partition folders and Spark splits a large partition by its bytes."""
    w = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite).

    A partition for which ``df`` has no row stays as it is: to replace the rows
    of a predicate, some of which may have no successor, use ``replace_where``.
    """
    (df.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return path


def replace_where(old: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """Rows of ``old`` not matching ``predicate`` plus rows of ``new`` that match it.

    NULL-safe: a row whose predicate is NULL counts as not matching. Write the
    result to a new path (a plain parquet folder cannot be overwritten while
    it is being read).
    """
    p = F.coalesce(predicate, F.lit(False))
    return old.filter(~p).unionByName(new.filter(p))
