"""Relational building blocks that keep plans scalable.

* ``sized_broadcast`` broadcasts a side only after checking its size in bytes.
* ``latest_per_key`` keeps one row per key with ``row_number() = 1``; Spark
  plans a partial group limit before the shuffle (map-side reduction), so a
  key holding a third of all rows never lands whole in one task.
* ``top_n_per_group`` uses ``row_number() <= n``; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle.
* ``salted_agg`` is the two-stage aggregation for skewed keys.
* ``global_row_number`` / ``global_ntile`` give exact global ranks without
  moving every row into one task (range partition + per-partition offsets).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Largest side we ask Spark to broadcast, by the bytes its optimizer estimates.
# Beyond it the join is left to Spark, which may still convert it at runtime.
BROADCAST_MAX_BYTES = 32 << 20


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only where the plan's size estimate (an upper bound for scans, filters and
    projections) is small; else leave it to AQE. Runs no job."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if n <= max_bytes else df


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple.

    ``order_by`` entries are columns compared descending (latest wins, NULLs
    last); give a total order (add a tie-break column) for a deterministic
    result. ``row_number() = 1`` plans a partial ``WindowGroupLimit`` before the
    shuffle, so each map task already keeps only one row per key and a key
    holding a third of all rows never reaches one task whole.
    """
    w = Window.partitionBy(*keys).orderBy(*[_col(c).desc_nulls_last() for c in order_by])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top_n_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                    n: int, rank_fn=F.row_number, rank_col: str | None = None) -> DataFrame:
    """QUALIFY-style filter: keep rows whose rank inside the group is <= n."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    name = rank_col or "_rk"
    out = df.withColumn(name, rank_fn().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def salted_agg(df: DataFrame, keys: Sequence[str], partial: dict[str, Column],
               final: dict[str, Column], salt_by: Sequence[str], buckets: int = 16) -> DataFrame:
    """Two-stage aggregation for skewed keys.

    Stage 1 groups by (keys, salt) with ``partial`` aggregates; stage 2 groups
    by keys with ``final`` aggregates over the partial columns. The salt is a
    hash of ``salt_by`` columns, so a retried task sees the same salt.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_by]), F.lit(buckets)))
    stage1 = salted.groupBy(*keys, "_salt").agg(*[v.alias(k) for k, v in partial.items()])
    return stage1.groupBy(*keys).agg(*[v.alias(k) for k, v in final.items()])


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str = "rn",
                      total_col: str | None = None) -> DataFrame:
    """Exact 1-based row number over a total order, without a single-task window.

    Range-partitions by the order, sorts inside partitions, then adds each
    partition's offset (a table with one row per partition, so its broadcast is
    bounded by the partition count). The tagged data is checkpointed so the
    position ids are stable even if executors are lost. Give a total order
    (end with a unique column): rows with equal sort values share a range
    partition, so a huge tie group would otherwise stay in one task.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = list(order_by)
    tagged = (df.repartitionByRange(*order)
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = out.withColumn(name, F.col("_off") + pos + F.lit(1))
    if total_col:
        out = out.withColumnRenamed("_total", total_col)
    else:
        out = out.drop("_total")
    return out.drop("_pid", "_mid", "_off")


def ntile_from_position(rn: Column, total: Column, n: int) -> Column:
    """SQL ntile bucket for a 1-based position ``rn`` among ``total`` rows."""
    q = F.floor(total / n).cast("long")
    r = (total % n).cast("long")
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1) \
            .otherwise(r + F.floor((rn - 1 - big) / q) + 1).cast("long")


def global_ntile(df: DataFrame, n: int, order_by: Sequence[Column], name: str) -> DataFrame:
    """Exact ``ntile(n) over (order by ...)`` computed without a global window."""
    ranked = global_row_number(df, order_by, name="_rn", total_col="_cnt")
    return ranked.withColumn(name, ntile_from_position(F.col("_rn"), F.col("_cnt"), n)) \
                 .drop("_rn", "_cnt")


def null_safe_equal_all(left: Sequence[Column], right: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond
