"""A change log kept in files: a folder per version, and snapshots of the state now and then.

``<path>/log/_commit_version=<n>/`` holds the change rows of version n, and
``<path>/snapshots/version=<n>/`` the table's rows as of it. Reads name the versions
they need, so Spark prunes the other folders; a state is read from the last
snapshot before it and the versions since, never from the whole log.

Versions are written once, in order, by one writer. A version written again (a
replayed batch) replaces its folder. An empty version leaves no folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import changelog as cl
from ..sources.sinks import overwrite_partitions

VERSION = "_commit_version"


def _snapshot_path(path: str, version: int) -> str:
    return f"{path}/snapshots/version={version}"


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose snapshot was written to its end, in rising order (a folder listing)."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshots/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found)


def append_changes(changes: DataFrame, path: str, keys: Sequence[str], version: int, capture: bool = True,
                   snapshot_every: int | None = 10) -> None:
    """Write the change rows of ``version``, all others in ``changes`` are left out.

    With ``capture`` the feed has the rows as they were before updates too; without it
    only what states need is kept. Every ``snapshot_every`` versions the state is written.
    """
    rows = changes.filter(F.col(VERSION) == version)
    if not capture:
        rows = rows.filter(F.col("_change_type") != cl.PRE)
    overwrite_partitions(rows, f"{path}/log", [VERSION])
    if snapshot_every and version % snapshot_every == 0:
        state_at(changes.sparkSession, path, keys, version).write.mode("overwrite").parquet(_snapshot_path(path, version))


def read_changes(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Change rows of the versions ``start`` to ``end``, both included; only their folders are read."""
    log = spark.read.parquet(f"{path}/log").withColumn(VERSION, F.col(VERSION).cast("long"))
    log = log if start is None else log.filter(F.col(VERSION) >= start)
    return log if end is None else log.filter(F.col(VERSION) <= end)


def state_at(spark: SparkSession, path: str, keys: Sequence[str], version: int) -> DataFrame:
    """The table as of ``version``: the last snapshot at or before it, with the changes since."""
    before = [v for v in snapshot_versions(spark, path) if v <= version]
    if not before:
        return cl.as_of_version(read_changes(spark, path, end=version), keys, version)
    snapshot = spark.read.parquet(_snapshot_path(path, before[-1]))
    if before[-1] == version:
        return snapshot
    tail = read_changes(spark, path, before[-1] + 1, version)
    return cl.as_of_version(tail, keys, version, snapshot=snapshot, snapshot_version=before[-1])


def version_at(spark: SparkSession, path: str, ts: str) -> int | None:
    """Last version committed at or before ``ts`` (None: there is none)."""
    return cl.version_at(read_changes(spark, path), ts)


def changed_keys(spark: SparkSession, path: str, keys: Sequence[str], start: int, end: int) -> DataFrame:
    """Keys with a change in the versions ``start`` to ``end``."""
    return read_changes(spark, path, start, end).select(*keys).distinct()


def net_changes(spark: SparkSession, path: str, keys: Sequence[str], old: int, new: int) -> DataFrame:
    """Rows by which the state at ``new`` differs from that at ``old``: ``_side`` is 'removed' or 'added'.

    Only keys that changed between the two are compared. A row that changed and was
    changed back is in neither side.
    """
    lo, hi = sorted((old, new))
    touched = changed_keys(spark, path, keys, lo + 1, hi)
    at = {v: state_at(spark, path, keys, v).join(touched, list(keys), "left_semi") for v in (old, new)}
    cols = at[old].columns
    sides = at[old].withColumn("_n", F.lit(-1)).unionByName(at[new].withColumn("_n", F.lit(1)))
    net = sides.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    return net.select(*cols, F.when(F.col("_n") > 0, "added").otherwise("removed").alias("_side"))


def undo(spark: SparkSession, path: str, keys: Sequence[str], version: int, predicate: Column, to: int) -> DataFrame:
    """The state at ``version`` with rows of ``predicate`` as they were at ``to``; keys absent there stay as they are.

    Only keys that changed since ``to`` are looked up, so the cost is that of the changes.
    """
    now = state_at(spark, path, keys, version)
    cols = now.columns
    touched = changed_keys(spark, path, keys, to + 1, version)
    old = state_at(spark, path, keys, to).join(touched, list(keys), "left_semi")
    old = old.select(*[F.col(c).alias(f"_old_{c}") for c in cols], F.lit(True).alias("_was"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_old_{k}"))
    back = F.col("_was").isNotNull() & F.coalesce(predicate, F.lit(False))
    return now.join(old, same, "left").select(*[F.when(back, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
