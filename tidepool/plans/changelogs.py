"""Time travel and change data feed (survey 2.10, 2.11).

The change log is built from ``orders`` by four commits:
v0 load every order; v1 update urgent open orders to F with +10 % price;
v2 delete low-priority pending orders; v3 a bad update that multiplies the
price of medium-priority fulfilled orders by 10.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import change_table as ct
from ..operators import changelog as cl
from ..operators.merge import WhenMatched, merge
from ..sources.tables import Tables
from .merges import SRC_SQL, TGT_SQL, merge_source, merge_target
from .registry import register

KEYS = ["o_orderkey"]
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
TS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00",
      "2024-01-05 00:00:00"]


def _p1():
    return (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")


def _p2():
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")


def _p3():
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "3-MEDIUM")


def orders_log(t: Tables) -> DataFrame:
    s0 = t.orders.select(*COLS)
    a1 = {"o_orderstatus": F.lit("F"), "o_totalprice": rnd(F.col("o_totalprice") * 1.1, 2)}
    v1 = cl.commit_update(s0, _p1(), a1, 1, TS[1])
    s1 = s0.select(*[F.when(_p1(), a1[c]).otherwise(F.col(c)).alias(c) if c in a1 else F.col(c) for c in COLS])
    v2 = cl.commit_delete(s1, _p2(), 2, TS[2])
    s2 = s1.filter(~F.coalesce(_p2(), F.lit(False)))
    a3 = {"o_totalprice": F.col("o_totalprice") * 10}
    v3 = cl.commit_update(s2, _p3(), a3, 3, TS[3])
    return cl.commit_insert(s0, 0, TS[0]).unionByName(v1).unionByName(v2).unionByName(v3)


P1 = "o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"
P2 = "o_orderstatus = 'P' AND o_orderpriority = '5-LOW'"
P3 = "o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'"
STATES = f"""s0 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
s1 AS (SELECT o_orderkey, o_custkey, CASE WHEN {P1} THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN {P1} THEN round(o_totalprice * 1.1, 2) ELSE o_totalprice END AS o_totalprice,
              o_orderpriority FROM s0),
s2 AS (SELECT * FROM s1 WHERE NOT coalesce({P2}, false)),
s3 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN {P3} THEN o_totalprice * 10 ELSE o_totalprice END AS o_totalprice,
              o_orderpriority FROM s2)"""
LOG = f"""{STATES},
log AS (
  SELECT *, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version,
         TIMESTAMP '{TS[0]}' AS _commit_timestamp FROM s0
  UNION ALL SELECT *, 'update_preimage', 1, TIMESTAMP '{TS[1]}' FROM s0 WHERE {P1}
  UNION ALL SELECT *, 'update_postimage', 1, TIMESTAMP '{TS[1]}' FROM s1
            WHERE o_orderkey IN (SELECT o_orderkey FROM s0 WHERE {P1})
  UNION ALL SELECT *, 'delete', 2, TIMESTAMP '{TS[2]}' FROM s1 WHERE {P2}
  UNION ALL SELECT *, 'update_preimage', 3, TIMESTAMP '{TS[3]}' FROM s2 WHERE {P3}
  UNION ALL SELECT *, 'update_postimage', 3, TIMESTAMP '{TS[3]}' FROM s3
            WHERE o_orderkey IN (SELECT o_orderkey FROM s2 WHERE {P3}))"""


@register("as_of_version", ops=("TTR1",), oracle=f"WITH {STATES} SELECT * FROM s2")
def as_of_version(spark: SparkSession, sf: str) -> DataFrame:
    return cl.as_of_version(orders_log(Tables(spark, sf)), KEYS, 2)


@register("as_of_timestamp", ops=("TTR2",), oracle=f"WITH {STATES} SELECT * FROM s1")
def as_of_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return cl.as_of_timestamp(orders_log(Tables(spark, sf)), KEYS, "2024-01-02 12:00:00")


@register("change_history", ops=("TTR3",), oracle=f"""WITH {LOG},
g AS (SELECT _commit_version, _commit_timestamp,
        count(*) FILTER (WHERE _change_type = 'insert') AS n_inserted,
        count(*) FILTER (WHERE _change_type = 'update_postimage') AS n_updated,
        count(*) FILTER (WHERE _change_type = 'delete') AS n_deleted
      FROM log GROUP BY 1, 2)
SELECT *, CASE WHEN (n_inserted > 0)::INT + (n_updated > 0)::INT + (n_deleted > 0)::INT > 1 THEN 'MERGE'
               WHEN n_inserted > 0 THEN 'WRITE' WHEN n_updated > 0 THEN 'UPDATE'
               WHEN n_deleted > 0 THEN 'DELETE' ELSE 'NOOP' END AS operation
FROM g""")
def change_history(spark: SparkSession, sf: str) -> DataFrame:
    return cl.history(orders_log(Tables(spark, sf)))


DIFFERS = ("NOT (a.o_custkey IS NOT DISTINCT FROM b.o_custkey AND a.o_orderstatus IS NOT DISTINCT FROM "
           "b.o_orderstatus AND a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice AND "
           "a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority)")


@register("restore_version", ops=("TTR4",), oracle=f"""WITH {STATES}
SELECT b.*, 'insert' AS _change_type, CAST(4 AS BIGINT) AS _commit_version,
       TIMESTAMP '{TS[4]}' AS _commit_timestamp
FROM s1 b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s3)
UNION ALL
SELECT a.*, 'update_preimage', 4, TIMESTAMP '{TS[4]}' FROM s3 a JOIN s1 b USING (o_orderkey) WHERE {DIFFERS}
UNION ALL
SELECT b.*, 'update_postimage', 4, TIMESTAMP '{TS[4]}' FROM s3 a JOIN s1 b USING (o_orderkey) WHERE {DIFFERS}
UNION ALL
SELECT a.*, 'delete', 4, TIMESTAMP '{TS[4]}' FROM s3 a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s1)
""")
def restore_version(spark: SparkSession, sf: str) -> DataFrame:
    """RESTORE to version 1 as a new commit 4 (history is kept)."""
    return cl.restore(orders_log(Tables(spark, sf)), KEYS, 1, 4, TS[4])


@register("version_diff", ops=("TTR5", "SET2", "SET3", "PRJ14"), oracle=f"""WITH {STATES}
SELECT *, 'added' AS side FROM (SELECT * FROM s3 EXCEPT SELECT * FROM s0)
UNION
SELECT *, 'removed' AS side FROM (SELECT * FROM s0 EXCEPT SELECT * FROM s3)
""")
def version_diff(spark: SparkSession, sf: str) -> DataFrame:
    log = orders_log(Tables(spark, sf))
    v0, v3 = cl.as_of_version(log, KEYS, 0), cl.as_of_version(log, KEYS, 3)
    added = v3.subtract(v0).withColumn("side", F.lit("added"))
    removed = v0.subtract(v3).withColumn("side", F.lit("removed"))
    return added.union(removed).distinct()


@register("version_diff_full", ops=("JOI8",), oracle=f"""WITH {STATES}
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS kind,
  a.o_totalprice AS old_price, b.o_totalprice AS new_price
FROM s0 a FULL OUTER JOIN s3 b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR {DIFFERS}
""")
def version_diff_full(spark: SparkSession, sf: str) -> DataFrame:
    log = orders_log(Tables(spark, sf))
    a = cl.as_of_version(log, KEYS, 0).withColumn("_a", F.lit(True)).alias("a")
    b = cl.as_of_version(log, KEYS, 3).withColumn("_b", F.lit(True)).alias("b")
    j = a.join(b, F.col("a.o_orderkey") == F.col("b.o_orderkey"), "full_outer")
    same = F.lit(True)
    for c in COLS[1:]:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    kind = (F.when(F.col("a._a").isNull(), "added").when(F.col("b._b").isNull(), "removed")
            .when(~same, "changed"))
    return j.select(F.coalesce("a.o_orderkey", "b.o_orderkey").alias("o_orderkey"), kind.alias("kind"),
                    F.col("a.o_totalprice").alias("old_price"), F.col("b.o_totalprice").alias("new_price")) \
            .filter(F.col("kind").isNotNull())


@register("first_bad_version", ops=("TTR6",), oracle=f"""WITH {LOG}
SELECT o_orderkey, min(_commit_version) AS first_bad_version FROM log
WHERE _change_type IN ('insert', 'update_postimage') AND o_totalprice > 1000000
GROUP BY o_orderkey
""")
def first_bad_version(spark: SparkSession, sf: str) -> DataFrame:
    """Audit in one pass over the log instead of one query per version."""
    return cl.first_version_where(orders_log(Tables(spark, sf)), KEYS, F.col("o_totalprice") > 1_000_000)


@register("selective_undo", ops=("TTR7",), oracle=f"""WITH {STATES}
SELECT a.o_orderkey, a.o_custkey, a.o_orderstatus,
  CASE WHEN a.o_orderpriority = '3-MEDIUM' AND b.o_orderkey IS NOT NULL THEN b.o_totalprice
       ELSE a.o_totalprice END AS o_totalprice, a.o_orderpriority
FROM s3 a LEFT JOIN s0 b ON a.o_orderkey = b.o_orderkey
""")
def selective_undo(spark: SparkSession, sf: str) -> DataFrame:
    """Copy the prices of medium-priority orders back from version 0."""
    log = orders_log(Tables(spark, sf))
    current = cl.as_of_version(log, KEYS, 3)
    old = cl.as_of_version(log, KEYS, 0)
    return merge(current, old, KEYS, [
        WhenMatched("t.o_orderpriority = '3-MEDIUM'", update={"o_totalprice": "s.o_totalprice"})])


@register("pinned_report", ops=("TTR8",), oracle=f"""WITH {STATES}
SELECT o_orderstatus, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue FROM s1 GROUP BY 1
""")
def pinned_report(spark: SparkSession, sf: str) -> DataFrame:
    s = cl.as_of_version(orders_log(Tables(spark, sf)), KEYS, 1)
    return s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"),
                                          rnd(F.sum("o_totalprice"), 2).alias("revenue"))


@register("cdf_read", ops=("CDF1", "CDF2"), oracle=f"WITH {LOG} SELECT * FROM log WHERE _commit_version >= 1")
def cdf_read(spark: SparkSession, sf: str) -> DataFrame:
    return cl.changes_between(orders_log(Tables(spark, sf)), 1)


@register("cdf_inserts", ops=("CDF3",), oracle=f"""WITH {LOG}
SELECT * FROM log WHERE _commit_version >= 0 AND _change_type IN ('insert', 'delete')
""")
def cdf_inserts(spark: SparkSession, sf: str) -> DataFrame:
    return cl.changes_between(orders_log(Tables(spark, sf)), 0).filter(
        F.col("_change_type").isin(cl.INSERT, cl.DELETE))


@register("cdf_propagate", ops=("CDF4",), oracle=f"WITH {STATES} SELECT * FROM s3")
def cdf_propagate(spark: SparkSession, sf: str) -> DataFrame:
    """A replica at version 0 plus the feed since version 1 equals the source at version 3."""
    log = orders_log(Tables(spark, sf))
    replica = cl.as_of_version(log, KEYS, 0)
    return cl.apply_changes(replica, cl.changes_between(log, 1), KEYS)


@register("cdf_from_merge", ops=("CDF5",), oracle=f"""WITH {TGT_SQL}, {SRC_SQL}
SELECT s.*, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version,
       TIMESTAMP '{TS[1]}' AS _commit_timestamp
FROM src s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
UNION ALL
SELECT t.*, 'update_preimage', 1, TIMESTAMP '{TS[1]}' FROM tgt t JOIN src s USING (o_orderkey)
UNION ALL
SELECT s.*, 'update_postimage', 1, TIMESTAMP '{TS[1]}' FROM tgt t JOIN src s USING (o_orderkey)
""")
def cdf_from_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Feed of an upsert: diff of the target before and after the merge."""
    from .merges import merge_upsert
    t = Tables(spark, sf)
    before = merge_target(t)
    after = merge_upsert(spark, sf)
    _ = merge_source
    return cl.diff_changes(before, after, KEYS, 1, TS[1])


@register("as_of_snapshot_tail", ops=("TTR1", "TTR8"), oracle=f"WITH {STATES} SELECT * FROM s3")
def as_of_snapshot_tail(spark: SparkSession, sf: str) -> DataFrame:
    """State at version 3 read from a materialised snapshot of version 1 plus
    the log tail, instead of the latest change per key over the whole log."""
    from ..session import scratch_path
    log = orders_log(Tables(spark, sf))
    snap = cl.snapshot(log, KEYS, 1, scratch_path(spark, "orders_snapshot_v1"))
    return cl.as_of_version(log, KEYS, 3, snapshot=snap, snapshot_version=1)


def written_log(spark: SparkSession, sf: str, name: str, capture: bool = True, snapshot_every: int | None = 2) -> str:
    """The log of ``orders_log`` in files, version after version."""
    from ..session import scratch_path
    path, log = scratch_path(spark, name), orders_log(Tables(spark, sf))
    for version in range(4):
        ct.append_changes(log, path, KEYS, version, capture, snapshot_every)
    return path


@register("cdf_propagate_written", ops=("CDF1", "CDF4"), oracle=f"WITH {STATES} SELECT * FROM s3")
def cdf_propagate_written(spark: SparkSession, sf: str) -> DataFrame:
    """A replica at version 0 plus the written feed since version 1: four scans of files, old versions pruned."""
    path = written_log(spark, sf, "cdf_written")
    return cl.apply_changes(ct.state_at(spark, path, KEYS, 0), ct.read_changes(spark, path, 1), KEYS)


@register("cdf_without_preimages", ops=("CDF1", "CDF2"), oracle=f"""WITH {LOG}
SELECT * FROM log WHERE _commit_version BETWEEN 1 AND 2 AND _change_type <> 'update_preimage'""")
def cdf_without_preimages(spark: SparkSession, sf: str) -> DataFrame:
    """Feed of versions 1 and 2 from a log written with the capture of pre-images off."""
    return ct.read_changes(spark, written_log(spark, sf, "cdf_off", capture=False), 1, 2)


@register("as_of_written", ops=("TTR1", "TTR2"), oracle=f"""WITH {STATES}
SELECT *, 2 AS version FROM s2 UNION ALL SELECT *, 3 FROM s3""")
def as_of_written(spark: SparkSession, sf: str) -> DataFrame:
    """Version 2 by its timestamp, a snapshot alone, and version 3, that snapshot with one version after it."""
    path = written_log(spark, sf, "as_of_written")
    found = ct.version_at(spark, path, "2024-01-03 12:00:00")
    return (ct.state_at(spark, path, KEYS, found).withColumn("version", F.lit(found).cast("int"))
            .unionByName(ct.state_at(spark, path, KEYS, 3).withColumn("version", F.lit(3))))


@register("net_changes_written", ops=("TTR5",), oracle=f"""WITH {STATES}
(SELECT *, 'added' AS _side FROM (SELECT * FROM s3 EXCEPT ALL SELECT * FROM s1))
UNION ALL (SELECT *, 'removed' AS _side FROM (SELECT * FROM s1 EXCEPT ALL SELECT * FROM s3))""")
def net_changes_written(spark: SparkSession, sf: str) -> DataFrame:
    """Difference of versions 1 and 3, by the keys that changed between them."""
    return ct.net_changes(spark, written_log(spark, sf, "net_written"), KEYS, 1, 3)


@register("undo_written", ops=("TTR7",), oracle=f"""WITH {STATES}
SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN a.o_custkey ELSE b.o_custkey END AS o_custkey,
  CASE WHEN b.o_orderkey IS NULL THEN a.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
  CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
  a.o_orderpriority
FROM s3 a LEFT JOIN s2 b ON a.o_orderkey = b.o_orderkey AND a.o_orderpriority = '3-MEDIUM'""")
def undo_written(spark: SparkSession, sf: str) -> DataFrame:
    """Medium-priority orders of version 3 as they were at version 2."""
    path = written_log(spark, sf, "undo_written")
    return ct.undo(spark, path, KEYS, 3, F.col("o_orderpriority") == "3-MEDIUM", 2)
