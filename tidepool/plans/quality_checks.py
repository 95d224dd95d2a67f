"""Schema enforcement, constraints and data quality (survey 2.12, plus AGG19 and PRJ9/PRJ10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.merge import WhenMatched, WhenNotMatched, merge
from ..sources.tables import Tables
from ..session import scratch_path
from .merges import SRC_SQL, TGT_SQL, merge_source, merge_target
from .registry import register


@register("enforce_strict", ops=("CON1",), oracle="SELECT * FROM orders")
def enforce_strict(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with exactly the table schema passes unchanged (a mismatch raises)."""
    o = Tables(spark, sf).orders
    return q.enforce(o, o.schema, mode="strict")


@register("enforce_project", ops=("CON2",), oracle="SELECT * FROM orders")
def enforce_project(spark: SparkSession, sf: str) -> DataFrame:
    """The batch carries an extra discount column; the explicit projection drops it."""
    o = Tables(spark, sf).orders
    batch = o.withColumn("discount_pct", F.when(F.col("o_orderstatus") == "F", 0.05).otherwise(0.0))
    return q.enforce(batch, o.schema, mode="project")


@register("enforce_cast", ops=("CON3",), oracle="""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS l_quantity
FROM lineitem
""")
def enforce_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Quantities arrive as text (returned lines as '<n> units'); try_cast makes misfits NULL."""
    batch, target = _text_quantities(spark, sf)
    return q.enforce(batch, target, mode="cast")


@register("enforce_cast_misfits", ops=("CON3",), oracle="""
SELECT count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity IS NOT NULL) AS l_quantity FROM lineitem
""")
def enforce_cast_misfits(spark: SparkSession, sf: str) -> DataFrame:
    """How many values that cast would make NULL."""
    return q.cast_misfits(*_text_quantities(spark, sf))


def _text_quantities(spark: SparkSession, sf: str):
    """Lines with their quantity as text, and the schema they should have."""
    li = Tables(spark, sf).lineitem
    qty_text = F.when(F.col("l_returnflag") == "R", F.concat(F.col("l_quantity").cast("string"), F.lit(" units"))) \
                .otherwise(F.col("l_quantity").cast("string"))
    batch = li.select("l_orderkey", "l_linenumber", qty_text.alias("l_quantity"))
    return batch, li.select("l_orderkey", "l_linenumber", "l_quantity").schema


@register("evolve_append", ops=("CON5", "SET4"), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_channel FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'phone' ELSE 'web' END AS o_channel FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-01-01'
""")
def evolve_append(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    old = o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_custkey", "o_totalprice")
    new = o.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", "phone").otherwise("web").alias("o_channel"))
    return q.evolve_append(old, new)


@register("schema_overwrite", ops=("SNK4", "CON4", "SNK1"), oracle="""
SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1
""")
def schema_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Write orders, then overwrite the same path with a different schema; only the new one remains."""
    path = scratch_path(spark, "schema_overwrite")
    o = Tables(spark, sf).orders
    o.write.mode("overwrite").parquet(path)
    summary = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    summary.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


ORDER_RULES = [q.not_null("o_orderstatus"), q.Rule("positive_amount", "o_totalprice > 100000")]


@register("constraint_filter", ops=("CON6", "CON7", "CON9", "CON10"), oracle="""
SELECT * FROM orders WHERE o_orderstatus IS NOT NULL AND o_totalprice > 100000
""")
def constraint_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Keep only rows satisfying the table rules before an insert."""
    valid, _rejected = q.split(Tables(spark, sf).orders, ORDER_RULES)
    return valid


@register("constraint_merge", ops=("CON9",), oracle=f"""WITH {TGT_SQL}, {SRC_SQL},
ok AS (SELECT * FROM src WHERE o_orderstatus IS NOT NULL AND o_totalprice > 100000)
SELECT * FROM ok
UNION ALL
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ok)
""")
def constraint_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Filter the merge source by the target's rules, then upsert."""
    t = Tables(spark, sf)
    valid, _ = q.split(merge_source(t), ORDER_RULES)
    return merge(merge_target(t), valid, ["o_orderkey"], [WhenMatched(update="*"), WhenNotMatched()])


EVENT_EXPECTATIONS = {
    "valid_value": "value >= 0 AND value <= 45",
    "known_type": "event_type IN ('view', 'click', 'purchase', 'signup')",
    "has_props": "props IS NOT NULL AND props LIKE '{%'",
}


@register("expectations_report", ops=("DQ1", "CON8"), oracle="""
SELECT 'valid_value' AS rule, 'value >= 0 AND value <= 45' AS expression,
       count(*) FILTER (WHERE NOT coalesce(value >= 0 AND value <= 45, false)) AS failed, count(*) AS total
FROM events
UNION ALL
SELECT 'known_type', 'event_type IN (''view'', ''click'', ''purchase'', ''signup'')',
       count(*) FILTER (WHERE NOT coalesce(event_type IN ('view', 'click', 'purchase', 'signup'), false)), count(*)
FROM events
UNION ALL
SELECT 'has_props', 'props IS NOT NULL AND props LIKE ''{%''',
       count(*) FILTER (WHERE NOT coalesce(props IS NOT NULL AND props LIKE '{%', false)), count(*)
FROM events
""")
def expectations_report(spark: SparkSession, sf: str) -> DataFrame:
    """Expect (keep rows, count violations) - all counters from one aggregate."""
    rules = [q.Rule(k, v) for k, v in EVENT_EXPECTATIONS.items()]
    return q.violation_counts(Tables(spark, sf).events, rules)


@register("expect_or_drop", ops=("DQ2", "DQ3"), oracle="""
SELECT * FROM events WHERE coalesce(value >= 0 AND value <= 45, false)
  AND coalesce(event_type IN ('view', 'click', 'purchase', 'signup'), false)
  AND coalesce(props IS NOT NULL AND props LIKE '{%', false)
""")
def expect_or_drop(spark: SparkSession, sf: str) -> DataFrame:
    return q.expect(Tables(spark, sf).events, EVENT_EXPECTATIONS, action="drop")


LOADS = {"early": "ts < TIMESTAMP '2024-01-11'", "late": "ts >= TIMESTAMP '2024-01-11'"}
EVENT_ACTIONS = {"known_type": "drop", "has_props": "drop"}  # the others warn


def _counts_sql() -> str:
    rules = {k: f"coalesce({v}, false)" for k, v in EVENT_EXPECTATIONS.items()}
    kept = " AND ".join(rules[k] for k in EVENT_ACTIONS)
    return " UNION ALL ".join(
        f"""SELECT '{load}' AS load_id, '{k}' AS rule, '{EVENT_ACTIONS.get(k, "warn")}' AS action,
  count(*) FILTER (WHERE NOT {rule}) AS failed, count(*) AS total, count(*) FILTER (WHERE {kept}) AS written,
  (SELECT count(*) FROM events WHERE {kept}) AS rows_in_table FROM events WHERE {where}"""
        for load, where in LOADS.items() for k, rule in rules.items())


@register("expectation_counts", ops=("DQ1", "DQ2"), oracle=_counts_sql())
def expectation_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads write their rows and count their expectations in one scan each; the second load runs
    twice, as after a crash, and replaces its rows and counts."""
    events = Tables(spark, sf).events
    base = scratch_path(spark, "expectation_counts")
    rules = [q.Expectation(k, v, EVENT_ACTIONS.get(k, "warn")) for k, v in EVENT_EXPECTATIONS.items()]
    for load in ("early", "late", "late"):
        q.write_expected(events.filter(LOADS[load]), f"{base}/rows/load={load}", rules, f"{base}/metrics", load, "events", "overwrite")
    written = spark.read.parquet(f"{base}/rows").agg(F.count(F.lit(1)).alias("rows_in_table"))
    counts = spark.read.parquet(f"{base}/metrics").select("load_id", "rule", "action", "failed", "total", "written")
    return counts.withColumn("rows_in_table", F.lit(written.first()[0]))


@register("ref_integrity", ops=("DQ8",), oracle="""
SELECT 'orders' AS dimension, (SELECT count(*) FROM lineitem) AS fact_rows,
       count(DISTINCT l.l_orderkey) AS missing_keys, count(l.l_orderkey) AS orphan_rows
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'part', (SELECT count(*) FROM lineitem), count(DISTINCT l.l_partkey), count(l.l_partkey)
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'supplier', (SELECT count(*) FROM lineitem), count(DISTINCT l.l_suppkey), count(l.l_suppkey)
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
""")
def ref_integrity(spark: SparkSession, sf: str) -> DataFrame:
    """Missing dimension keys for three dimensions: one anti join each, unioned."""
    t = Tables(spark, sf)
    li = t.lineitem
    parts = []
    for name, dim, fk, pk in [("orders", t.orders, "l_orderkey", "o_orderkey"),
                              ("part", t.part, "l_partkey", "p_partkey"),
                              ("supplier", t.supplier, "l_suppkey", "s_suppkey")]:
        keys = dim.select(F.col(pk).alias(fk)).distinct().withColumn("_hit", F.lit(True))
        j = li.select(fk).join(keys, fk, "left")
        miss = F.col("_hit").isNull()
        parts.append(j.agg(F.count(F.lit(1)).alias("fact_rows"),
                           F.countDistinct(F.when(miss, F.col(fk))).alias("missing_keys"),
                           F.count(F.when(miss, F.col(fk))).alias("orphan_rows"))
                     .select(F.lit(name).alias("dimension"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("quality_report", ops=("DQ4", "PRJ12", "SET1"), oracle="""WITH c AS (
SELECT 'orders' AS table_name, 'key_not_null' AS check_name, count(*) AS total,
       count(*) FILTER (WHERE o_orderkey IS NOT NULL) AS passed FROM orders
UNION ALL SELECT 'orders', 'positive_price', count(*), count(*) FILTER (WHERE o_totalprice > 0) FROM orders
UNION ALL SELECT 'orders', 'known_status', count(*), count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'lineitem', 'positive_quantity', count(*), count(*) FILTER (WHERE l_quantity > 0) FROM lineitem
UNION ALL SELECT 'lineitem', 'discount_range', count(*), count(*) FILTER (WHERE l_discount BETWEEN 0 AND 0.1) FROM lineitem
UNION ALL SELECT 'customer', 'non_negative_balance', count(*), count(*) FILTER (WHERE c_acctbal >= 0) FROM customer
UNION ALL SELECT 'customer', 'name_format', count(*), count(*) FILTER (WHERE regexp_full_match(c_name, 'Customer#[0-9]{9}')) FROM customer)
SELECT *, round(CAST(passed AS DOUBLE) / total, 4) AS pass_rate FROM c
""")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return q.quality_report({
        "orders": (t.orders, {"key_not_null": "o_orderkey IS NOT NULL", "positive_price": "o_totalprice > 0",
                              "known_status": "o_orderstatus IN ('F', 'O', 'P')"}),
        "lineitem": (t.lineitem, {"positive_quantity": "l_quantity > 0",
                                  "discount_range": "l_discount BETWEEN 0 AND 0.1"}),
        "customer": (t.customer, {"non_negative_balance": "c_acctbal >= 0",
                                  "name_format": "c_name RLIKE '^Customer#[0-9]{9}$'"}),
    })


@register("tier_quality_report", ops=("DQ4",), oracle="""
WITH silver AS (SELECT l.* FROM lineitem l WHERE l_quantity > 0 AND l_extendedprice > 0),
gold AS (SELECT o.o_orderdate, sum(l_extendedprice) AS revenue FROM silver l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1),
c(tier, check_name, total, passed) AS (
SELECT 'bronze', 'key_not_null', count(*), count(l_orderkey) FROM lineitem
UNION ALL SELECT 'silver', 'positive_price', count(*), count(*) FILTER (WHERE l_extendedprice > 0) FROM silver
UNION ALL SELECT 'silver', 'order_exists', count(*), count(*) FILTER (WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l_orderkey AND o.o_orderstatus <> 'P')) FROM silver
UNION ALL SELECT 'gold', 'positive_revenue', count(*), count(*) FILTER (WHERE revenue > 0) FROM gold)
SELECT *, round(CAST(passed AS DOUBLE) / total, 4) AS pass_rate FROM c
""")
def tier_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Checks of three tiers in one report, among them orphans: lines without an order that is not pending."""
    t = Tables(spark, sf)
    bronze = t.lineitem
    silver = bronze.filter("l_quantity > 0 AND l_extendedprice > 0")
    settled = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("known")).distinct()
    silver_checked = silver.join(settled, F.col("l_orderkey") == F.col("known"), "left")
    gold = (silver.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_orderdate").agg(F.sum("l_extendedprice").alias("revenue")))
    return q.quality_report({
        "bronze": (bronze, {"key_not_null": "l_orderkey IS NOT NULL"}),
        "silver": (silver_checked, {"positive_price": "l_extendedprice > 0", "order_exists": "known IS NOT NULL"}),
        "gold": (gold, {"positive_revenue": "revenue > 0"}),
    }).withColumnRenamed("table_name", "tier")


@register("contact_quality", ops=("PRJ9", "FUN2", "DQ5", "DQ6"), oracle="""
WITH s AS (
  SELECT c_custkey, c_name,
    regexp_replace(c_name, '[^0-9]', '', 'g') AS name_digits,
    CAST(length(c_name) AS INTEGER) AS name_length,
    CASE WHEN regexp_matches(c_name, '^Customer#[0-9]{9}$') THEN 1 ELSE 0 END
    + CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END
    + CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 1 ELSE 0 END
      AS quality_score
  FROM customer)
SELECT * FROM s WHERE quality_score >= 2
""")
def contact_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Per-row quality score from validation flags, then a minimum-standard filter."""
    c = Tables(spark, sf).customer
    score = (F.when(F.col("c_name").rlike("^Customer#[0-9]{9}$"), 1).otherwise(0)
             + F.when(F.col("c_acctbal") >= 0, 1).otherwise(0)
             + F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), 1)
             .otherwise(0))
    s = c.select("c_custkey", "c_name", F.regexp_replace("c_name", "[^0-9]", "").alias("name_digits"),
                 F.length("c_name").alias("name_length"), score.alias("quality_score"))
    return s.filter(F.col("quality_score") >= 2)


@register("profile_table", ops=("AGG19", "DQ7", "DQ9"), oracle="""
SELECT count(*) AS total_rows,
  count(c_custkey) AS c_custkey_non_null, count(DISTINCT c_custkey) AS c_custkey_distinct,
  count(c_nationkey) AS c_nationkey_non_null, count(DISTINCT c_nationkey) AS c_nationkey_distinct,
  count(c_mktsegment) AS c_mktsegment_non_null, count(DISTINCT c_mktsegment) AS c_mktsegment_distinct,
  count(*) FILTER (WHERE c_acctbal < 0) AS negative_balance,
  count(*) FILTER (WHERE c_nationkey IS NULL) AS missing_nation
FROM customer
""")
def profile_table(spark: SparkSession, sf: str) -> DataFrame:
    return q.profile(Tables(spark, sf).customer, ["c_custkey", "c_nationkey", "c_mktsegment"],
                     {"negative_balance": "c_acctbal < 0", "missing_nation": "c_nationkey IS NULL"})


# Rule weights and the alert threshold of the risk score.
RISK_WEIGHTS = {"high_amount": 30, "purchase": 20, "hot_props": 25, "night": 15}
RISK_ALERT_ABOVE = 70


def risk_score_expr():
    """Weighted sum of the four rule flags (0-90)."""
    k = F.from_json("props", "k INT").getField("k")
    return (F.when(F.col("value") > 40, RISK_WEIGHTS["high_amount"]).otherwise(0)
            + F.when(F.col("event_type") == "purchase", RISK_WEIGHTS["purchase"]).otherwise(0)
            + F.when(k > 80, RISK_WEIGHTS["hot_props"]).otherwise(0)
            + F.when(F.hour("ts") < 6, RISK_WEIGHTS["night"]).otherwise(0))


def risk_score_df(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "ts", "value", risk_score_expr().alias("risk_score")) \
                 .withColumn("is_alert", F.col("risk_score") > RISK_ALERT_ABOVE)


@register("risk_score", ops=("PRJ10", "PRJ11"), oracle="""
SELECT event_id, user_id, ts, value,
  CASE WHEN value > 40 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END
  + CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 THEN 25 ELSE 0 END
  + CASE WHEN hour(ts) < 6 THEN 15 ELSE 0 END AS risk_score,
  (CASE WHEN value > 40 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END
  + CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 THEN 25 ELSE 0 END
  + CASE WHEN hour(ts) < 6 THEN 15 ELSE 0 END) > 70 AS is_alert
FROM events
""")
def risk_score(spark: SparkSession, sf: str) -> DataFrame:
    return risk_score_df(Tables(spark, sf).events)



@register("quality_by_nation", ops=("DQ7",), oracle="""
WITH s AS (
  SELECT c_nationkey,
    CASE WHEN regexp_matches(c_name, '^Customer#[0-9]{9}$') THEN 1 ELSE 0 END
    + CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END
    + CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 1 ELSE 0 END
      AS quality_score
  FROM customer)
SELECT c_nationkey, count(*) AS n_customers, CAST(sum(quality_score) AS BIGINT) AS score_total,
       sum(quality_score) / count(*) AS avg_quality_score,
       count(*) FILTER (WHERE quality_score = 3) AS fully_valid
FROM s GROUP BY c_nationkey
""")
def quality_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    """Average per-row quality score per entity (nation)."""
    c = Tables(spark, sf).customer
    score = (F.when(F.col("c_name").rlike("^Customer#[0-9]{9}$"), 1).otherwise(0)
             + F.when(F.col("c_acctbal") >= 0, 1).otherwise(0)
             + F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), 1)
             .otherwise(0))
    s = c.select("c_nationkey", score.alias("quality_score"))
    return s.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers"), F.sum("quality_score").cast("long").alias("score_total"),
        (F.sum("quality_score") / F.count(F.lit(1))).alias("avg_quality_score"),
        F.count(F.when(F.col("quality_score") == 3, 1)).alias("fully_valid"))
