"""Versions, time travel and change feeds over a change-log DataFrame.

A change log holds one row per changed row per commit: the key, the row
columns, ``_change_type`` (insert, update_preimage, update_postimage, delete),
``_commit_version`` and ``_commit_timestamp``. Writing a commit appends rows;
every read below is a DataFrame job over the log:

* the state as of a version is the latest non-preimage change per key with
  deletes dropped (an aggregate, so hot keys are reduced map-side);
* ``snapshot`` materialises a state so ``as_of_version`` can read snapshot +
  tail instead of the whole log;
* diffs between states are one full outer join on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import WhenMatched, WhenNotMatched, merge, null_salt
from .relational import latest_per_key, null_safe_equal_all

INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"
META = ["_change_type", "_commit_version", "_commit_timestamp"]


def _stamp(df: DataFrame, change_type, version: int, ts: str) -> DataFrame:
    ct = F.lit(change_type) if isinstance(change_type, str) else change_type
    return df.select("*", ct.alias("_change_type"), F.lit(version).cast("long").alias("_commit_version"),
                     F.lit(ts).cast("timestamp_ntz").alias("_commit_timestamp"))


def commit_insert(rows: DataFrame, version: int, ts: str) -> DataFrame:
    return _stamp(rows, INSERT, version, ts)


def commit_update(state: DataFrame, predicate: Column, assignments: Mapping[str, Column],
                  version: int, ts: str) -> DataFrame:
    """Pre- and post-images for ``UPDATE ... SET assignments WHERE predicate``."""
    hit = state.filter(F.coalesce(predicate, F.lit(False)))
    post = hit.select(*[assignments[c].alias(c) if c in assignments else F.col(c) for c in state.columns])
    return _stamp(hit, PRE, version, ts).unionByName(_stamp(post, POST, version, ts))


def commit_delete(state: DataFrame, predicate: Column, version: int, ts: str) -> DataFrame:
    return _stamp(state.filter(F.coalesce(predicate, F.lit(False))), DELETE, version, ts)


def diff_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int, ts: str) -> DataFrame:
    """Change rows turning ``old`` into ``new``: inserts, deletes, update pre/post images.

    Rows whose values are all equal (NULL-safe) produce nothing.
    """
    keys = list(keys)
    cols = old.columns
    o = old.withColumn("_op", F.lit(True)).withColumn("_nk", null_salt(old, keys, 1)).alias("o")
    n = new.select(*cols).withColumn("_np", F.lit(True)).withColumn("_nk", null_salt(new, keys, -1)).alias("n")
    cond = F.col("o._nk") == F.col("n._nk")  # NULL keys never match; the salt spreads them
    for k in keys:
        cond = cond & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    j = o.join(n, cond, "full_outer")
    op, np_ = F.col("o._op").isNotNull(), F.col("n._np").isNotNull()
    same = null_safe_equal_all([F.col(f"o.{c}") for c in cols], [F.col(f"n.{c}") for c in cols])
    kind = (F.when(op & np_ & ~same, F.lit("u")).when(np_ & ~op, F.lit(INSERT))
            .when(op & ~np_, F.lit(DELETE)))
    j = j.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    # One row per change; updates fan out into a pre and a post image.
    img = F.explode(F.when(F.col("_kind") == "u", F.array(F.lit(PRE), F.lit(POST)))
                    .otherwise(F.array(F.col("_kind")))).alias("_change_type")
    j = j.select("*", img)
    from_new = F.col("_change_type").isin(INSERT, POST)
    rows = j.select(*[F.when(from_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in cols],
                    "_change_type")
    return rows.select(*cols, "_change_type",
                       F.lit(version).cast("long").alias("_commit_version"),
                       F.lit(ts).cast("timestamp_ntz").alias("_commit_timestamp"))


def as_of_version(log: DataFrame, keys: Sequence[str], version: int,
                  snapshot: DataFrame | None = None, snapshot_version: int | None = None) -> DataFrame:
    """Table state at ``version`` (optionally from a materialised snapshot plus the log tail)."""
    cols = [c for c in log.columns if c not in META]
    live = log.filter((F.col("_commit_version") <= version) & (F.col("_change_type") != PRE))
    if snapshot is not None:
        base = _stamp(snapshot.select(*cols), INSERT, snapshot_version, "1970-01-01")
        live = base.unionByName(live.filter(F.col("_commit_version") > snapshot_version))
    latest = latest_per_key(live, keys, ["_commit_version"])
    return latest.filter(F.col("_change_type") != DELETE).select(*cols)


def version_at(log: DataFrame, ts: str) -> Column:
    """Scalar: last version committed at or before ``ts``."""
    return log.filter(F.col("_commit_timestamp") <= F.lit(ts).cast("timestamp_ntz")) \
              .agg(F.max("_commit_version")).first()[0]


def as_of_timestamp(log: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """State as of a timestamp: rows of every commit at or before ``ts``."""
    cols = [c for c in log.columns if c not in META]
    live = log.filter((F.col("_commit_timestamp") <= F.lit(ts).cast("timestamp_ntz"))
                      & (F.col("_change_type") != PRE))
    latest = latest_per_key(live, keys, ["_commit_version"])
    return latest.filter(F.col("_change_type") != DELETE).select(*cols)


def snapshot(log: DataFrame, keys: Sequence[str], version: int, path: str) -> DataFrame:
    """Materialise the state at ``version`` as parquet (cuts the log's lineage)."""
    as_of_version(log, keys, version).write.mode("overwrite").parquet(path)
    return log.sparkSession.read.parquet(path)


def history(log: DataFrame) -> DataFrame:
    """One row per commit: counts per change type and an operation label."""
    g = log.groupBy("_commit_version", "_commit_timestamp").agg(
        F.count(F.when(F.col("_change_type") == INSERT, 1)).alias("n_inserted"),
        F.count(F.when(F.col("_change_type") == POST, 1)).alias("n_updated"),
        F.count(F.when(F.col("_change_type") == DELETE, 1)).alias("n_deleted"))
    kinds = (F.when(F.col("n_inserted") > 0, 1).otherwise(0) + F.when(F.col("n_updated") > 0, 1).otherwise(0)
             + F.when(F.col("n_deleted") > 0, 1).otherwise(0))
    op = (F.when(kinds > 1, "MERGE").when(F.col("n_inserted") > 0, "WRITE")
          .when(F.col("n_updated") > 0, "UPDATE").when(F.col("n_deleted") > 0, "DELETE").otherwise("NOOP"))
    return g.withColumn("operation", op)


def restore(log: DataFrame, keys: Sequence[str], to_version: int, new_version: int, ts: str) -> DataFrame:
    """Commit rows that bring the latest state back to ``to_version`` (history kept)."""
    current = as_of_version(log, keys, new_version - 1)
    target = as_of_version(log, keys, to_version)
    return diff_changes(current, target, keys, new_version, ts)


def first_version_where(log: DataFrame, keys: Sequence[str], predicate: Column) -> DataFrame:
    """Per key, the first version whose written row satisfies ``predicate`` (one pass)."""
    written = log.filter(F.col("_change_type").isin(INSERT, POST) & F.coalesce(predicate, F.lit(False)))
    return written.groupBy(*keys).agg(F.min("_commit_version").alias("first_bad_version"))


def changes_between(log: DataFrame, start: int, end: int | None = None) -> DataFrame:
    c = F.col("_commit_version") >= start
    if end is not None:
        c = c & (F.col("_commit_version") <= end)
    return log.filter(c)


def apply_changes(downstream: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Propagate a change feed: latest non-preimage change per key, then merge
    (delete / update / insert)."""
    cols = downstream.columns
    latest = latest_per_key(changes.filter(F.col("_change_type") != PRE), keys, ["_commit_version"])
    return merge(downstream, latest.select(*cols, "_change_type"), keys, [
        WhenMatched("s._change_type = 'delete'", delete=True),
        WhenMatched(update={c: f"s.{c}" for c in cols}),
        WhenNotMatched("s._change_type != 'delete'", insert={c: f"s.{c}" for c in cols}),
    ])
