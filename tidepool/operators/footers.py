"""Reports from Parquet footers: rows, bytes and column ranges without reading any data page.

The files are listed by Spark and dealt over tasks; a task reads the footer of
each of its files (some kB at its end) and gives a row per row group and column.
So a report costs what the number of files costs, whatever their size.

Files are opened with ``pyarrow.fs`` by the URI that Spark lists (file, hdfs, s3,
gs, abfs). Where a footer has no range for a column (old writers, INT96 times,
NaN), the row group counts as one that may match. A column that a file lacks, such
as a folder's partition column, has no range there.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections.abc import Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import list_files

# The functions travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files whose footers one task reads, about; a footer takes some milliseconds.
FILES_A_TASK = 200

SCHEMA = ("path string, file_bytes long, row_group int, rows long, column string, min string, max string, "
          "nulls long, compressed_bytes long, may_match boolean")


def _open(uri: str):
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _comparable(v):
    """A footer's or a caller's value in a form that both share, keeping its order."""
    if isinstance(v, dt.datetime):
        v = v if v.tzinfo else v.replace(tzinfo=dt.timezone.utc)
        return v
    return v.encode("utf-8") if isinstance(v, str) else v


def _may_hold(stats, rows: int, value) -> bool:
    """Whether a row group whose column has these statistics may hold ``value`` (None: a NULL)."""
    if stats is None:
        return True
    if value is None:
        return not stats.has_null_count or stats.null_count > 0
    if stats.has_null_count and stats.null_count == rows:
        return False
    if not stats.has_min_max:
        return True
    low, high, v = _comparable(stats.min), _comparable(stats.max), _comparable(value)
    if isinstance(v, float) and math.isnan(v):
        return True
    try:
        return low <= v <= high
    except TypeError:
        return True


def _text(v) -> str | None:
    return None if v is None else v.isoformat() if hasattr(v, "isoformat") else str(v)


def _reader(columns: Sequence[str], probe: Mapping[str, object]):
    def read(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        for batch in batches:
            out = []
            for path, length in zip(batch["path"], batch["length"]):
                with _open(path) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    chunks = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
                    match = all(_may_hold(chunks[c].statistics if c in chunks else None, group.num_rows, v)
                                for c, v in probe.items())
                    for c in columns:
                        chunk = chunks.get(c)
                        s = chunk.statistics if chunk is not None else None
                        ranged = s is not None and s.has_min_max
                        out.append((path, length, g, group.num_rows, c, _text(s.min) if ranged else None,
                                    _text(s.max) if ranged else None,
                                    s.null_count if s is not None and s.has_null_count else None,
                                    chunk.total_compressed_size if chunk is not None else None, match))
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"nulls": "Int64", "compressed_bytes": "Int64"})
    return read


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str],
                 probe: Mapping[str, object] | None = None) -> DataFrame:
    """A row per file, row group and column of ``columns``: rows, smallest and largest value (as text), NULLs, bytes.

    ``may_match`` says whether the row group may hold rows with ``column = value`` for
    all of ``probe`` (a value of None asks for NULL). Nested fields are named by
    their path in the file. A file without row groups gives no row.
    """
    files = list_files(spark, path).select("path", "length")
    splits = files.rdd.getNumPartitions()
    # Spark deals the listing by the files' bytes; a footer's cost does not depend on them.
    wide = max(1, min(splits, max(spark.sparkContext.defaultParallelism, math.ceil(len(files.inputFiles()) / FILES_A_TASK))))
    return files.coalesce(wide).mapInPandas(_reader(list(columns), dict(probe or {})), SCHEMA)


def footer_report(spark: SparkSession, path: str, probe: Mapping[str, object]) -> DataFrame:
    """One row: files, bytes, row groups and rows, and how many of each a point filter on ``probe`` must read."""
    column = next(iter(probe))
    groups = footer_stats(spark, path, [column], probe)
    hit = F.col("may_match")
    files = groups.groupBy("path", "file_bytes").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("rows").alias("rows"), F.max("may_match").alias("hit"),
        F.count(F.when(hit, 1)).alias("groups_hit"), F.sum(F.when(hit, F.col("rows")).otherwise(0)).alias("rows_hit"))
    return files.agg(
        F.count(F.lit(1)).alias("total_files"), F.count(F.when(F.col("hit"), 1)).alias("files_to_read"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("groups"), F.lit(0)).alias("total_groups"),
        F.coalesce(F.sum("groups_hit"), F.lit(0)).alias("groups_to_read"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("rows_hit"), F.lit(0)).alias("rows_to_read"))
