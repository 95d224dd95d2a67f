"""Replaying a table as a stream in the order of its event time.

A window's state is dropped once the watermark has passed the window. A table read
in one micro-batch holds the windows of all its rows at once, and one read in
several micro-batches of any order loses rows behind the watermark. Read in
order of event time, each micro-batch holds its own windows and those still
open, and no row is late.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import list_files
from .runner import few_stores

#: Rows of state that a micro-batch adds to a state store; some 250 bytes each in an executor's heap.
ROWS_A_STORE = 500_000


def slices_for(rows: DataFrame, state_rows: int) -> int:
    """Slices of event time so that the few stores take in ``ROWS_A_STORE`` rows of state a slice, at ``state_rows`` for each of its rows."""
    return max(1, math.ceil(rows.count() * state_rows / (ROWS_A_STORE * few_stores(rows.sparkSession))))


def land_by_time(rows: DataFrame, time_col: str, path: str, slices: int) -> bool:
    """Land ``rows`` as files of one slice of event time each, earlier slices first, for ``replayed``; returns whether they can be read one by one.

    File streams read files in the order of their times of change, so the slices land one after the
    other, in small jobs. Where the storage's times don't tell them apart, or there is
    one slice, only a micro-batch of all files loses no row. Rows of one event time are in one slice.
    """
    spark, staged, landing = rows.sparkSession, f"{path}/slices", f"{path}/landing"
    if slices == 1:
        rows.write.parquet(landing)
        return False
    rows.repartitionByRange(slices, time_col).sortWithinPartitions(time_col).write.parquet(staged)
    for name in sorted(r[0] for r in list_files(spark, staged).select("path").collect()):  # a file a slice, numbered in their order
        spark.read.schema(rows.schema).parquet(name).coalesce(1).write.mode("append").parquet(landing)
    time = F.unix_micros(F.col(time_col).cast("timestamp"))
    files = (spark.read.schema(rows.schema).parquet(landing)
             .groupBy(F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_path"))
             .agg(F.min(time).alias("first"), F.max(time).alias("last")).collect())
    files = sorted(files, key=lambda f: f["changed"])
    timed = [f for f in files if f["first"] is not None]
    return (all(a["changed"] < b["changed"] for a, b in zip(files, files[1:], strict=False))
            and all(a["last"] <= b["first"] for a, b in zip(timed, timed[1:], strict=False)))


def replayed(rows: DataFrame, path: str, one_by_one: bool, slices_a_batch: int = 1) -> DataFrame:
    """The rows that ``land_by_time`` landed, as a stream of micro-batches of some slices each, or of one if they can't be read one by one."""
    r = rows.sparkSession.readStream.schema(rows.schema)
    if one_by_one:
        r = r.option("maxFilesPerTrigger", slices_a_batch)
    return r.parquet(f"{path}/landing")
