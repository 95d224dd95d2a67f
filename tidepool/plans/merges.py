"""Upserts, predicate updates/deletes and slowly changing dimensions (survey 2.9).

Fixtures derived from the test tables:
* merge target: orders placed before 2000 (the historic load);
* merge source: orders from 1999 on (the new batch) with changed values: price
  +10 %, status rotated F->O->P->F, ``updated_at`` one day after the order
  date for urgent/high priority and one day before it otherwise. 1999 orders
  match, later ones are inserts, earlier ones are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import relational as rel
from ..operators.merge import (MergeBuilder, WhenMatched, WhenNotMatched, WhenNotMatchedBySource,
                               merge)
from ..operators.scd import auto_cdc_scd2, current_rows, multi_version_keys, scd2_merge
from ..sources.tables import Tables
from .registry import register

MERGE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "updated_at"]
PROCESSED_AT = "2024-01-01 00:00:00"


def merge_target(t: Tables) -> DataFrame:
    o = t.orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    F.col("o_orderdate").alias("updated_at"))


def merge_source(t: Tables) -> DataFrame:
    o = t.orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    rotated = (F.when(F.col("o_orderstatus") == "F", "O").when(F.col("o_orderstatus") == "O", "P")
               .otherwise("F"))
    shift = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.expr("INTERVAL 1 DAY")) \
             .otherwise(F.expr("INTERVAL -1 DAY"))
    return o.select("o_orderkey", "o_custkey", rotated.alias("o_orderstatus"),
                    rnd(F.col("o_totalprice") * 1.1, 2).alias("o_totalprice"), "o_orderdate",
                    (F.col("o_orderdate") + shift).alias("updated_at"))


TGT_SQL = """tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderdate AS updated_at
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""
SRC_SQL = """src AS (
  SELECT o_orderkey, o_custkey,
    CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'P' ELSE 'F' END AS o_orderstatus,
    round(o_totalprice * 1.1, 2) AS o_totalprice, o_orderdate,
    o_orderdate + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN INTERVAL 1 DAY
                       ELSE INTERVAL '-1' DAY END AS updated_at
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"""
WITH = f"WITH {TGT_SQL}, {SRC_SQL}"


@register("merge_upsert", ops=("MRG1", "SCD1", "MRG12"), oracle=f"""{WITH}
SELECT * FROM src
UNION ALL
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
""")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return (MergeBuilder(merge_target(t), merge_source(t), ["o_orderkey"])
            .whenMatchedUpdateAll().whenNotMatchedInsertAll().execute())


@register("merge_insert_only", ops=("MRG2",), oracle=f"""{WITH}
SELECT * FROM tgt
UNION ALL
SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
""")
def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"], [WhenNotMatched()])


HOT_TGT_SQL = """tgt AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS o_key, l_orderkey, l_linenumber, l_quantity,
    l_returnflag AS flag, l_shipdate AS changed FROM lineitem),
src AS (
  SELECT CASE WHEN o_orderkey < 4 THEN 0 ELSE o_orderkey END AS o_key, o_orderstatus AS flag, o_orderdate + INTERVAL 60 DAY AS changed
  FROM orders WHERE o_orderkey % 2 = 1 AND (o_orderkey = 3 OR o_orderkey > 3)
  UNION ALL
  SELECT -1 - (o_orderkey % 3) * o_orderkey, 'N', o_orderdate FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0)"""


@register("merge_hot_key", ops=("MRG1", "MRG3", "MRG6", "MRG7", "MRG14"), oracle=f"""WITH {HOT_TGT_SQL},
j AS (SELECT t.*, s.o_key IS NOT NULL AS has, s.flag AS s_flag, s.changed AS s_changed FROM tgt t LEFT JOIN src s ON t.o_key = s.o_key)
SELECT o_key, l_orderkey, l_linenumber, l_quantity,
       CASE WHEN has AND s_changed > changed THEN s_flag ELSE flag END AS flag,
       CASE WHEN has AND s_changed > changed THEN s_changed ELSE changed END AS changed
FROM j WHERE NOT (has AND s_flag = 'P') AND NOT (NOT has AND l_quantity < 5)
UNION ALL
SELECT o_key, NULL, NULL, NULL, flag, changed FROM src WHERE o_key NOT IN (SELECT o_key FROM tgt)
""")
def merge_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """All clauses on a target with one key that holds a third of its rows, and several rows for the other keys too."""
    t = Tables(spark, sf)
    target = t.lineitem.select(F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")).cast("long").alias("o_key"),
                               "l_orderkey", "l_linenumber", "l_quantity", F.col("l_returnflag").alias("flag"),
                               F.col("l_shipdate").alias("changed"))
    odd = t.orders.filter("o_orderkey % 2 = 1 AND o_orderkey >= 3").select(
        F.when(F.col("o_orderkey") < 4, 0).otherwise(F.col("o_orderkey")).cast("long").alias("o_key"),
        F.col("o_orderstatus").alias("flag"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")).alias("changed"))
    new = t.orders.filter("o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0").select(
        (-1 - (F.col("o_orderkey") % 3) * F.col("o_orderkey")).cast("long").alias("o_key"), F.lit("N").alias("flag"),
        F.col("o_orderdate").alias("changed"))
    return merge(target, odd.unionByName(new), ["o_key"],
                 [WhenMatched("s.flag = 'P'", delete=True), WhenMatched("s.changed > t.changed", update={"flag": "s.flag", "changed": "s.changed"}),
                  WhenNotMatched(insert={"o_key": "s.o_key", "flag": "s.flag", "changed": "s.changed"}),
                  WhenNotMatchedBySource("t.l_quantity < 5", delete=True)],
                 spread_hot_keys=True)


@register("merge_update_only", ops=("MRG3",), oracle=f"""{WITH}
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN t.updated_at ELSE s.updated_at END AS updated_at
FROM tgt t LEFT JOIN src s ON t.o_orderkey = s.o_orderkey
""")
def merge_update_only(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"], [WhenMatched(update="*")])


@register("merge_if_newer", ops=("MRG5",), oracle=f"""{WITH}
SELECT s.* FROM src s JOIN tgt t ON s.o_orderkey = t.o_orderkey WHERE s.updated_at > t.updated_at
UNION ALL
SELECT t.* FROM tgt t LEFT JOIN src s ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR NOT (s.updated_at > t.updated_at)
UNION ALL
SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
""")
def merge_if_newer(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"],
                 [WhenMatched("s.updated_at > t.updated_at", update="*"), WhenNotMatched()])


@register("merge_with_delete", ops=("MRG6",), oracle=f"""{WITH}
SELECT s.* FROM src s JOIN tgt t ON s.o_orderkey = t.o_orderkey WHERE s.o_orderstatus <> 'P'
UNION ALL
SELECT t.* FROM tgt t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL
SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
""")
def merge_with_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Delete clause first: a matched source row with status P removes the target row."""
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"],
                 [WhenMatched("s.o_orderstatus = 'P'", delete=True), WhenMatched(update="*"),
                  WhenNotMatched()])


@register("merge_multi_clause", ops=("MRG7",), oracle=f"""{WITH}
SELECT s.* FROM src s JOIN tgt t ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderstatus <> 'P' AND s.updated_at > t.updated_at
UNION ALL
SELECT t.* FROM tgt t JOIN src s ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderstatus <> 'P' AND NOT (s.updated_at > t.updated_at)
UNION ALL
SELECT t.* FROM tgt t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL
SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
""")
def merge_multi_clause(spark: SparkSession, sf: str) -> DataFrame:
    """Delete, conditional update, insert; a matched row failing all clauses is kept."""
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"],
                 [WhenMatched("s.o_orderstatus = 'P'", delete=True),
                  WhenMatched("s.updated_at > t.updated_at", update="*"),
                  WhenNotMatched()])


@register("merge_by_source_delete", ops=("MRG14",), oracle=f"""{WITH}
SELECT * FROM src
UNION ALL
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
  AND NOT (o_orderdate < TIMESTAMP '1996-01-01')
""")
def merge_by_source_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Target rows absent from the source and older than 1996 are deleted."""
    t = Tables(spark, sf)
    return merge(merge_target(t), merge_source(t), ["o_orderkey"],
                 [WhenMatched(update="*"), WhenNotMatched(),
                  WhenNotMatchedBySource("t.o_orderdate < TIMESTAMP_NTZ '1996-01-01 00:00:00'", delete=True)])


@register("merge_schema_evolution", ops=("MRG9",), oracle=f"""{WITH}
SELECT *, CAST(CASE WHEN o_orderstatus = 'F' THEN 0.05 ELSE 0.0 END AS DOUBLE) AS discount_pct FROM src
UNION ALL
SELECT *, CAST(NULL AS DOUBLE) AS discount_pct FROM tgt
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
""")
def merge_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Source brings ``discount_pct``; untouched target rows get NULL."""
    t = Tables(spark, sf)
    src = merge_source(t).withColumn(
        "discount_pct", F.when(F.col("o_orderstatus") == "F", 0.05).otherwise(0.0))
    return (MergeBuilder(merge_target(t), src, ["o_orderkey"]).withSchemaEvolution()
            .whenMatchedUpdateAll().whenNotMatchedInsertAll().execute())


@register("silver_incremental_merge", ops=("MRG10",), oracle=f"""{WITH}
SELECT t.o_orderkey, t.o_custkey, s.o_orderstatus, s.o_totalprice, t.o_orderdate, t.updated_at,
       TIMESTAMP '{PROCESSED_AT}' AS processed_at
FROM tgt t JOIN src s ON s.o_orderkey = t.o_orderkey WHERE s.updated_at > t.updated_at
UNION ALL
SELECT t.*, CAST(NULL AS TIMESTAMP) AS processed_at
FROM tgt t LEFT JOIN src s ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR NOT (s.updated_at > t.updated_at)
UNION ALL
SELECT *, TIMESTAMP '{PROCESSED_AT}' AS processed_at
FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
""")
def silver_incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Partial update (status, price, processed time) when the source is newer."""
    t = Tables(spark, sf)
    tgt = merge_target(t).withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    ts = F.lit(PROCESSED_AT).cast("timestamp_ntz")
    return merge(tgt, merge_source(t), ["o_orderkey"], [
        WhenMatched("s.updated_at > t.updated_at",
                    update={"o_orderstatus": "s.o_orderstatus", "o_totalprice": "s.o_totalprice",
                            "processed_at": ts}),
        WhenNotMatched(insert={**{c: f"s.{c}" for c in MERGE_COLS}, "processed_at": ts}),
    ])


@register("gold_incremental_merge", ops=("MRG11", "JOI14"), oracle=f"""{WITH},
g AS (SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, count(*) AS n_orders,
             round(sum(o_totalprice), 2) AS revenue FROM tgt GROUP BY 1, 2),
b AS (SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, count(*) AS n_orders,
             round(sum(o_totalprice), 2) AS revenue FROM src GROUP BY 1, 2)
SELECT * FROM b
UNION ALL
SELECT g.* FROM g LEFT JOIN b ON g.order_date = b.order_date AND g.o_orderstatus = b.o_orderstatus
WHERE b.order_date IS NULL
""")
def gold_incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregate the new batch, then merge on the composite (day, status) key replacing values."""
    t = Tables(spark, sf)

    def daily(df):
        return df.groupBy(F.to_date("o_orderdate").alias("order_date"), "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n_orders"), rnd(F.sum("o_totalprice"), 2).alias("revenue"))

    return merge(daily(merge_target(t)), daily(merge_source(t)), ["order_date", "o_orderstatus"],
                 [WhenMatched(update={"n_orders": "s.n_orders", "revenue": "s.revenue"}),
                  WhenNotMatched()])


LINE_COLS_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_QUALIFY = """QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
  l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"""


@register("merge_dedup_source", ops=("MRG4", "MRG8"), oracle=f"""
WITH tgt AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' {LINE_QUALIFY}),
src AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' {LINE_QUALIFY})
SELECT * FROM src
UNION ALL
SELECT t.* FROM tgt t LEFT JOIN src s ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber
WHERE s.l_orderkey IS NULL
""")
def merge_dedup_source(spark: SparkSession, sf: str) -> DataFrame:
    """The raw batch repeats (order, line) keys; keep the latest per key, then upsert.

    Merging the raw batch would raise the ambiguity error.
    """
    li = Tables(spark, sf).lineitem
    keys = ["l_orderkey", "l_linenumber"]
    tgt = rel.latest_per_key(li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")),
                             keys, LINE_COLS_ORDER)
    raw = li.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    src = rel.latest_per_key(raw, keys, LINE_COLS_ORDER)
    return merge(tgt, src, keys, [WhenMatched(update="*"), WhenNotMatched()])


@register("predicate_update", ops=("UPD1",), oracle="""
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 'F' ELSE o_orderstatus END
    AS o_orderstatus,
  CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1997-01-01' THEN round(o_totalprice * 0.9, 2)
       ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def predicate_update(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    p = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    p = F.coalesce(p, F.lit(False))
    return o.select("o_orderkey",
                    F.when(p, F.lit("F")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                    F.when(p, rnd(F.col("o_totalprice") * 0.9, 2)).otherwise(F.col("o_totalprice"))
                    .alias("o_totalprice"))


@register("predicate_delete", ops=("UPD2",), oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT coalesce(o_orderstatus = 'P' AND o_totalprice < 50000, false)
""")
def predicate_delete(spark: SparkSession, sf: str) -> DataFrame:
    """DELETE WHERE p: rows where p is NULL are kept."""
    o = Tables(spark, sf).orders
    p = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000)
    return o.filter(~F.coalesce(p, F.lit(False))).select("o_orderkey", "o_custkey", "o_orderstatus")


# ------------------------------------------------------------------ SCD type 2

SCD_EFFECTIVE = "2024-01-01"
SCD_INITIAL_START = "1995-01-01"


def scd_dimension(t: Tables, versioned: bool = False) -> tuple[DataFrame, DataFrame]:
    """Initial customer dimension and the current batch.

    The dimension holds customers with balance <= 9000, with the market
    segment they had before: 'UNKNOWN' for customers now in debt. The batch is
    every customer's current (key, name, nation, segment): negative balances
    are changes, balances above 9000 are new customers.
    """
    c = t.customer
    prev_seg = F.when(F.col("c_acctbal") < 0, F.lit("UNKNOWN")).otherwise(F.col("c_mktsegment"))
    cols = [F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey"), prev_seg.alias("c_mktsegment"),
            F.lit(True).alias("is_current"),
            F.lit(SCD_INITIAL_START).cast("date").alias("effective_start_date")]
    if versioned:
        cols += [F.lit(None).cast("date").alias("effective_end_date"), F.lit(1).alias("version")]
    else:
        cols += [F.lit("9999-12-31").cast("date").alias("effective_end_date")]
    dim = c.filter(F.col("c_acctbal") <= 9000).select(*cols)
    batch = c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return dim, batch


SCD_ORACLE_BASE = f"""
WITH dim AS (SELECT c_custkey, c_name, c_nationkey,
                    CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS c_mktsegment
             FROM customer WHERE c_acctbal <= 9000),
batch AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer),
chg AS (SELECT b.* FROM batch b JOIN dim d ON b.c_custkey = d.c_custkey
        WHERE NOT (b.c_name IS NOT DISTINCT FROM d.c_name AND b.c_nationkey IS NOT DISTINCT FROM d.c_nationkey
                   AND b.c_mktsegment IS NOT DISTINCT FROM d.c_mktsegment)),
new AS (SELECT b.* FROM batch b WHERE b.c_custkey NOT IN (SELECT c_custkey FROM dim))"""


@register("scd2_merge", ops=("SCD2", "JOI13"), oracle=SCD_ORACLE_BASE + f"""
SELECT d.*, d.c_custkey NOT IN (SELECT c_custkey FROM chg) AS is_current,
       DATE '{SCD_INITIAL_START}' AS effective_start_date,
       CASE WHEN d.c_custkey IN (SELECT c_custkey FROM chg) THEN DATE '{SCD_EFFECTIVE}'
            ELSE DATE '9999-12-31' END AS effective_end_date
FROM dim d
UNION ALL
SELECT *, true, DATE '{SCD_EFFECTIVE}', DATE '9999-12-31' FROM chg
UNION ALL
SELECT *, true, DATE '{SCD_EFFECTIVE}', DATE '9999-12-31' FROM new
""")
def scd2_merge_q(spark: SparkSession, sf: str) -> DataFrame:
    """Type-2 merge; running it again with the same batch changes nothing."""
    dim, batch = scd_dimension(Tables(spark, sf))
    return scd2_merge(dim, batch, ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"], SCD_EFFECTIVE)


@register("scd2_versioned", ops=("SCD3",), oracle=SCD_ORACLE_BASE + f"""
SELECT d.*, d.c_custkey NOT IN (SELECT c_custkey FROM chg) AS is_current,
       DATE '{SCD_INITIAL_START}' AS effective_start_date,
       CASE WHEN d.c_custkey IN (SELECT c_custkey FROM chg) THEN DATE '{SCD_EFFECTIVE}' END AS effective_end_date,
       1 AS version
FROM dim d
UNION ALL
SELECT *, true, DATE '{SCD_EFFECTIVE}', CAST(NULL AS DATE), 2 FROM chg
UNION ALL
SELECT *, true, DATE '{SCD_EFFECTIVE}', CAST(NULL AS DATE), 1 FROM new
""")
def scd2_versioned(spark: SparkSession, sf: str) -> DataFrame:
    """Same operator with a NULL open end and a version number per key."""
    dim, batch = scd_dimension(Tables(spark, sf), versioned=True)
    return scd2_merge(dim, batch, ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"], SCD_EFFECTIVE,
                      open_end=None, version_col="version")


def cdc_feed(t: Tables) -> DataFrame:
    """Change feed per user: event_type is tracked, value is not; an event_type
    update is NULL ("no change") when value > 45."""
    ev = t.events
    return ev.select("user_id", "ts",
                     F.when(F.col("value") > 45, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
                     "value")


AUTO_CDC_ORACLE = """
WITH f AS (SELECT user_id, ts, CASE WHEN value > 45 THEN NULL ELSE event_type END AS event_type, value
           FROM events),
ff AS (SELECT user_id, ts, value,
         last_value(event_type IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_type FROM f),
fl AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                        OR event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts)
                      THEN 1 ELSE 0 END AS flag FROM ff),
v AS (SELECT *, sum(flag) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM fl),
g AS (SELECT user_id, ver, min(ts) AS __START_AT, first(event_type) AS event_type,
             arg_max(value, ts) AS value FROM v GROUP BY user_id, ver)
SELECT user_id, event_type, value, __START_AT,
       lead(__START_AT) OVER (PARTITION BY user_id ORDER BY ver) AS __END_AT
FROM g"""


@register("auto_cdc_scd2", ops=("SCD4", "SCD5"), oracle=AUTO_CDC_ORACLE)
def auto_cdc_scd2_q(spark: SparkSession, sf: str) -> DataFrame:
    return auto_cdc_scd2(cdc_feed(Tables(spark, sf)), ["user_id"], "ts", tracked=["event_type"])


@register("scd2_current", ops=("SCD6",), oracle=f"SELECT * FROM ({AUTO_CDC_ORACLE}) WHERE __END_AT IS NULL")
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return current_rows(auto_cdc_scd2_q(spark, sf))


@register("scd2_history", ops=("SCD7",), oracle=f"""
WITH h AS ({AUTO_CDC_ORACLE})
SELECT h.*, c.n_versions FROM h JOIN (SELECT user_id, count(*) AS n_versions FROM h GROUP BY 1
  HAVING count(*) > 1) c ON h.user_id = c.user_id
""")
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    return multi_version_keys(auto_cdc_scd2_q(spark, sf), ["user_id"])


@register("auto_cdc_stream", ops=("SCD4", "SCD5", "MRG13"), oracle=AUTO_CDC_ORACLE)
def auto_cdc_stream_q(spark: SparkSession, sf: str) -> DataFrame:
    """The same history built from a change stream arriving in four
    micro-batches whose files are not in sequence order: all keys are spliced."""
    from ..session import scratch_path
    from ..sources import files as fs
    from ..streaming.cdc import auto_cdc_stream
    base = scratch_path(spark, "auto_cdc_stream")
    feed = cdc_feed(Tables(spark, sf))
    fs.write_files(feed, f"{base}/landing", "parquet", 4)   # rows spread over files regardless of ts
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", fs.files_a_trigger(spark, f"{base}/landing", 4)).parquet(f"{base}/landing")
    return auto_cdc_stream(stream, ["user_id"], "ts", f"{base}/history", f"{base}/_checkpoint", num_buckets=8,
                           tracked=["event_type"]).history()


@register("auto_cdc_stream_in_order", ops=("SCD4", "SCD5", "SCD6", "MRG13"), oracle=f"SELECT * FROM ({AUTO_CDC_ORACLE}) WHERE __END_AT IS NULL")
def auto_cdc_stream_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Current rows of a history whose stream brings a quarter of the time in each micro-batch: keys go on from their state."""
    from ..session import scratch_path
    from ..streaming.cdc import auto_cdc_stream
    base = scratch_path(spark, "auto_cdc_in_order")
    feed = cdc_feed(Tables(spark, sf))
    feed.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{base}/landing")
    return current_rows(auto_cdc_stream(stream, ["user_id"], "ts", f"{base}/history", f"{base}/_checkpoint", num_buckets=8,
                                        tracked=["event_type"]).history())
