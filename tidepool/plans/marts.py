"""All marts of a pipeline from one run of its job (survey 2.15).

Every job writes its tables, and each later step reads what an earlier one wrote. A query
returns all marts of one run, stacked: column ``mart`` names the mart of a row, and columns
that a mart has not got are NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import layout as lay
from ..operators import quality as q
from ..session import scratch_path
from ..sources import files as fs
from ..sources.tables import Tables
from ..streaming.cdc import auto_cdc_stream
from ..streaming.replay import land_by_time, replayed, slices_for
from ..streaming.runner import drain_all, few_stores
from .merges import SRC_SQL, TGT_SQL
from .pipelines import RFM_CTE, customer_value, events_silver, medallion_job, orders_silver, payments_silver
from .quality_checks import RISK_ALERT_ABOVE, risk_score_expr
from .registry import register
from .streams import RETRIES_SQL, _bucket
from .windows import performance_tiers

MONEY = "decimal(18,2)"  # sums of it are exact, so they are the same in any order
MONEY_SUM = "decimal(28,2)"  # a sum of it
SMALL_MONEY, SMALL_MONEY_BELOW = "decimal(8,2)", 999_999  # its sums have 18 digits: 10 billion amounts


def stacked(marts: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of several marts in one table, under their names."""
    out = None
    for name, mart in marts.items():
        part = mart.select(F.lit(name).alias("mart"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as it was written to ``path``."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _money(c: str) -> F.Column:
    return F.col(c).cast(MONEY)


def _small_money(rows: DataFrame, c: str) -> F.Column:
    """``_money`` of fewer digits if every amount of ``rows`` has them: Spark adds up to 18 digits as longs, more of them as objects."""
    largest = rows.agg(F.max(F.abs(c))).first()[0]
    return F.col(c).cast(SMALL_MONEY) if largest is None or largest < SMALL_MONEY_BELOW else _money(c)


def _double(c) -> F.Column:
    return c.cast("double")


# ------------------------------------------------------------------ PIP2 payments

SPIKE_EVENTS = 2  # payments of one user within 10 minutes
HOURLY_LIMIT = 60  # amount of one user within an hour
SLIDING_WINDOWS = 12  # of an hour, one every 5 minutes, that hold one payment

PAYMENTS_CTE = f"""WITH {RETRIES_SQL},
silver AS (SELECT event_id, ts, user_id, event_type, props, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS DECIMAL(18, 2)) END AS value
           FROM (SELECT DISTINCT ON (event_id) * FROM src ORDER BY event_id, ts)),
velocity AS (SELECT user_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end, n_events
             FROM (SELECT user_id, {_bucket(600)} AS window_start, count(*) AS n_events FROM silver GROUP BY 1, 2)
             WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM silver) - INTERVAL 10 MINUTE),
x AS (SELECT s.*, {_bucket(300)} - k.k * INTERVAL 5 MINUTE AS window_start FROM silver s CROSS JOIN range(12) k(k)),
hourly AS (SELECT user_id, window_start, sum(value) AS amount FROM x GROUP BY 1, 2
           HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM silver) - INTERVAL 1 HOUR),
scored AS (SELECT s.*, coalesce(c.c_mktsegment, 'UNKNOWN') AS segment,
             CASE WHEN value > 40 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END
             + CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 THEN 25 ELSE 0 END
             + CASE WHEN hour(ts) < 6 THEN 15 ELSE 0 END AS risk_score
           FROM silver s LEFT JOIN customer c ON s.user_id = c.c_custkey),
alerts AS (SELECT * FROM scored WHERE risk_score > {RISK_ALERT_ABOVE}),
spikes AS (SELECT * FROM velocity WHERE n_events >= {SPIKE_EVENTS}),
daily AS (SELECT CAST(ts AS DATE) AS report_date, event_type, count(*) AS n_events, CAST(sum(value) AS DOUBLE) AS amount,
            CAST(sum(value) AS DOUBLE) / nullif(count(value), 0) AS avg_amount FROM silver GROUP BY 1, 2),
prefill AS (
  SELECT a.user_id, count(*) AS n_events, CAST(sum(value) AS DOUBLE) AS amount, max(risk_score) AS max_risk_score,
    (SELECT count(*) FROM spikes s WHERE s.user_id = a.user_id) AS n_spikes,
    (SELECT count(*) FROM hourly h WHERE h.user_id = a.user_id AND h.amount > {HOURLY_LIMIT}) AS n_hours_over_limit
  FROM alerts a GROUP BY a.user_id),
segments AS (SELECT segment, count(*) AS n_events, CAST(sum(value) AS DOUBLE) AS amount, max(risk_score) AS max_risk_score FROM alerts GROUP BY 1)
"""


def payments_job(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Silver payments feed three streams that run side by side: payments per user in tumbling windows, amounts per
    user in sliding windows, both in the order of event time, so that their state follows the open windows and not the
    table, and alerts (scored, with the customer's segment, into a sink). The reports are
    batches over their tables: a daily summary clustered by day and type, spikes, a prefilled report for every user with
    an alert, alerts by segment."""
    base = payments_silver(spark, sf)
    silver = spark.read.parquet(f"{base}/silver")
    stream = spark.readStream.schema(silver.schema).parquet(f"{base}/silver")
    timed, windows = silver.select("user_id", "ts", "value"), f"{base}/windows"
    one_by_one = land_by_time(timed, "ts", windows, slices_for(timed, SLIDING_WINDOWS))
    velocity = (replayed(timed, windows, one_by_one, SLIDING_WINDOWS).withWatermark("ts", "10 minutes")
                .groupBy("user_id", F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("n_events"))
                .select("user_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n_events"))
    amounts = replayed(timed, windows, one_by_one).repartition(few_stores(spark))  # a slice is one file; its rows go to all cores
    hourly = (amounts.withWatermark("ts", "1 hour").groupBy("user_id", F.window("ts", "1 hour", "5 minutes"))
              .agg(F.sum(_small_money(timed, "value")).alias("amount"))
              .select("user_id", F.col("window.start").alias("window_start"), F.col("amount").cast(MONEY_SUM).alias("amount")))
    customers = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    alerts = (stream.withColumn("risk_score", risk_score_expr()).filter(F.col("risk_score") > RISK_ALERT_ABOVE)
              .join(customers, F.col("user_id") == F.col("c_custkey"), "left")
              .select("event_id", "user_id", "ts", "value", "risk_score", F.coalesce("c_mktsegment", F.lit("UNKNOWN")).alias("segment")))
    drain_all({name: (df, f"{base}/{name}", f"{base}/_checkpoint_{name}")
               for name, df in (("velocity", velocity), ("hourly", hourly), ("alerts", alerts))}, few_keys=("velocity", "hourly"))
    velocity, hourly, alerts = (spark.read.parquet(f"{base}/{name}") for name in ("velocity", "hourly", "alerts"))

    total = F.sum(_money("value"))
    daily = silver.groupBy(F.to_date("ts").alias("report_date"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), _double(total).alias("amount"),
        F.try_divide(_double(total), F.count("value")).alias("avg_amount"))
    lay.apply_clustering(daily, lay.LayoutSpec(["report_date", "event_type"]), f"{base}/daily_summary", 4)
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    spikes = written(velocity.filter(F.col("n_events") >= SPIKE_EVENTS).select("user_id", *ntz, "n_events"), f"{base}/spikes")
    risky = [F.count(F.lit(1)).alias("n_events"), _double(total).alias("amount"), F.max("risk_score").alias("max_risk_score")]
    n_spikes = spikes.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_spikes"))
    n_hours = hourly.filter(F.col("amount") > HOURLY_LIMIT).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_hours_over_limit"))
    prefill = (alerts.groupBy("user_id").agg(*risky).join(n_spikes, "user_id", "left").join(n_hours, "user_id", "left")
               .fillna(0, ["n_spikes", "n_hours_over_limit"]))
    return {
        "daily_summary": spark.read.parquet(f"{base}/daily_summary"),
        "spikes": spikes,
        "prefill": written(prefill, f"{base}/prefill"),
        "segments": written(alerts.groupBy("segment").agg(*risky), f"{base}/segments"),
    }


@register("payments_marts", ops=("PIP2", "STM4", "STM5", "STM9"), oracle=f"""{PAYMENTS_CTE}
SELECT 'daily_summary' AS mart, * FROM daily
UNION ALL BY NAME SELECT 'spikes' AS mart, * FROM spikes
UNION ALL BY NAME SELECT 'prefill' AS mart, * FROM prefill
UNION ALL BY NAME SELECT 'segments' AS mart, * FROM segments
""")
def payments_marts(spark: SparkSession, sf: str) -> DataFrame:
    """All reports of one run of the payments job."""
    return stacked(payments_job(spark, sf))


# ------------------------------------------------------------------ PIP4 orders

def _orders_sql() -> str:
    return f"""{RFM_CTE},
sales AS (SELECT l_orderkey, o_custkey, c_mktsegment, CAST(o_orderdate AS DATE) AS day, p_partkey, p_type, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
days AS (SELECT day, c_mktsegment, count(DISTINCT l_orderkey) AS n_orders, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount FROM sales GROUP BY 1, 2),
daily AS (
  SELECT day, c_mktsegment, n_orders, CAST(amount AS DOUBLE) AS revenue,
    CAST(sum(amount) OVER w7 AS DOUBLE) / count(*) OVER w7 AS revenue_7_avg, CAST(sum(amount) OVER w30 AS DOUBLE) / count(*) OVER w30 AS revenue_30_avg,
    CAST(sum(n_orders) OVER w7 AS BIGINT) AS orders_7, CAST(sum(n_orders) OVER w30 AS BIGINT) AS orders_30
  FROM days
  WINDOW w7 AS (PARTITION BY c_mktsegment ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY c_mktsegment ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
parts AS (SELECT p_partkey, p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue, sum(l_quantity) AS units,
            count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT o_custkey) AS n_customers FROM sales GROUP BY 1, 2),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY p_type ORDER BY revenue DESC) AS revenue_rank,
    round(sum(revenue) OVER (PARTITION BY p_type), 2) AS category_revenue,
    round(sum(revenue) OVER (PARTITION BY p_type ORDER BY revenue DESC, p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cum_revenue
  FROM parts),
performance AS (
  SELECT p_partkey, p_type, revenue, units, n_orders, n_customers, revenue / units AS revenue_per_unit,
    CAST(n_orders AS DOUBLE) / n_customers AS orders_per_customer, revenue_rank, category_revenue,
    revenue / category_revenue * 100 AS market_share_pct, cum_revenue / category_revenue * 100 AS cumulative_share_pct,
    CASE WHEN revenue_rank <= 5 THEN 'Top Performer' WHEN revenue_rank <= 20 THEN 'Strong Performer'
         WHEN cum_revenue / category_revenue * 100 <= 80 THEN 'Average Performer' ELSE 'Underperformer' END AS performance_tier
  FROM ranked),
customers AS (
  SELECT customer_segment, ltv_category, c_mktsegment, count(*) AS n_customers, CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
  FROM seg JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT 'daily' AS mart, * FROM daily
UNION ALL BY NAME SELECT 'performance' AS mart, * FROM performance
UNION ALL BY NAME SELECT 'customers' AS mart, * FROM customers"""


def orders_job(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Silver orders and lines meet the current rows of the customer dimension in a sales table; its marts are daily
    sales per segment with rolling figures, parts with rank, share and tier, and customers by value and segment."""
    t = Tables(spark, sf)
    base = orders_silver(spark, sf)
    orders = spark.read.parquet(f"{base}/silver_orders")
    current = spark.read.parquet(f"{base}/dim_customer").filter("is_current").select("c_custkey", "c_mktsegment")
    sales = written(
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", _money("l_extendedprice").alias("amount"))
        .join(orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(current, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")), f"{base}/silver_sales")

    days = sales.groupBy("day", "c_mktsegment").agg(F.count_distinct("l_orderkey").alias("n_orders"), F.sum("amount").alias("amount"))
    by_day = Window.partitionBy("c_mktsegment").orderBy("day")  # a row a day: a segment's days fit one task
    rolling = [F.col("day"), F.col("c_mktsegment"), F.col("n_orders"), _double(F.col("amount")).alias("revenue")]
    for n in (7, 30):
        w = by_day.rowsBetween(1 - n, 0)
        rolling += [(_double(F.sum("amount").over(w)) / F.count(F.lit(1)).over(w)).alias(f"revenue_{n}_avg"),
                    F.sum("n_orders").over(w).alias(f"orders_{n}")]

    parts = written(sales.groupBy("p_partkey", "p_type").agg(
        _double(F.sum("amount")).alias("revenue"), F.sum("l_quantity").alias("units"),
        F.count_distinct("l_orderkey").alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers")), f"{base}/parts")
    figures = parts.select("p_partkey", "units", "n_orders", "n_customers", (F.col("revenue") / F.col("units")).alias("revenue_per_unit"),
                           (F.col("n_orders") / F.col("n_customers")).alias("orders_per_customer"))
    performance = performance_tiers(parts.select("p_partkey", "p_type", "revenue")).join(figures, "p_partkey")

    value = customer_value(orders).join(current, F.col("o_custkey") == F.col("c_custkey"))
    customers = value.groupBy("customer_segment", "ltv_category", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"), _double(F.sum(_money("monetary"))).alias("revenue"))
    return {"daily": written(days.select(*rolling), f"{base}/mart_daily"),
            "performance": written(performance, f"{base}/mart_performance"),
            "customers": written(customers, f"{base}/mart_customers")}


@register("orders_marts", ops=("PIP4",), oracle=_orders_sql())
def orders_marts(spark: SparkSession, sf: str) -> DataFrame:
    """All marts of one run of the orders job."""
    return stacked(orders_job(spark, sf))


# ------------------------------------------------------------------ PIP3 shop events

#: The approximate distinct count has a relative standard error of 5 %; four of them and one item are allowed.
ITEM_ERROR = 0.2


@register("events_marts", ops=("PIP3",), oracle="""
WITH e AS (SELECT e.*, CAST(value AS DECIMAL(18, 2)) AS price, CAST(ts AS DATE) AS day, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS item,
             coalesce(c.c_mktsegment, 'UNKNOWN') AS segment, c_custkey FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
bought AS (SELECT e.*, p_name, p_type FROM e LEFT JOIN part ON item = p_partkey WHERE event_type = 'purchase'),
daily AS (SELECT day, item, p_name, p_type, count(*) AS n_purchases, sum(price) AS revenue FROM bought GROUP BY ALL),
users AS (SELECT user_id, segment, sum(price) AS revenue, count(*) AS n_purchases, count(DISTINCT item) AS n_items, max(ts) AS last_purchase FROM bought GROUP BY ALL),
top_items AS (SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM daily WHERE day = (SELECT max(day) FROM daily) ORDER BY n_purchases DESC, item NULLS LAST LIMIT 5),
category_days AS (SELECT day, p_type, CAST(sum(revenue) AS DOUBLE) AS revenue FROM daily GROUP BY ALL),
top_users AS (SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue), true AS items_in_bound FROM users ORDER BY users.revenue DESC, user_id LIMIT 10),
unknown AS (SELECT count(*) AS n_events FROM e WHERE c_custkey IS NULL)
SELECT 'top_items' AS mart, * FROM top_items
UNION ALL BY NAME SELECT 'category_days' AS mart, * FROM category_days
UNION ALL BY NAME SELECT 'top_users' AS mart, * FROM top_users
UNION ALL BY NAME SELECT 'unknown' AS mart, * FROM unknown
""")
def events_marts(spark: SparkSession, sf: str) -> DataFrame:
    """One run of the shop-event job, its daily item table and its user table, and the questions put to them: the five items most
    bought on the latest day, revenue per category and day, the ten best customers (with an approximate number of
    their items beside the exact one), events of unknown customers."""
    t = Tables(spark, sf)
    base, enriched = events_silver(spark, sf)
    item = F.from_json("props", "k INT").getField("k").alias("item")
    parts = t.part.select(F.col("p_partkey"), "p_name", "p_type")
    bought = (enriched.filter("event_type = 'purchase'").select("user_id", "segment", "ts", F.to_date("ts").alias("day"), item, _money("value").alias("price"))
              .join(parts, F.col("item") == F.col("p_partkey"), "left"))
    daily = written(bought.groupBy("day", "item", "p_name", "p_type").agg(F.count(F.lit(1)).alias("n_purchases"), F.sum("price").alias("revenue")),
                    f"{base}/daily_items")
    users = written(bought.groupBy("user_id", "segment").agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("n_purchases"), F.count_distinct("item").alias("n_items"),
        F.approx_count_distinct("item").alias("n_items_approx"), F.max("ts").cast("timestamp_ntz").alias("last_purchase")), f"{base}/users")
    latest = daily.agg(F.max("day").alias("day"))
    top_items = daily.join(latest, "day").orderBy(F.desc("n_purchases"), F.asc_nulls_last("item")).limit(5)
    close = F.abs(F.col("n_items_approx") - F.col("n_items")) <= ITEM_ERROR * F.col("n_items") + 1
    top_users = users.withColumn("items_in_bound", close).drop("n_items_approx").orderBy(F.desc("revenue"), "user_id").limit(10)
    return stacked({
        "top_items": top_items.withColumn("revenue", _double(F.col("revenue"))),
        "category_days": daily.groupBy("day", "p_type").agg(_double(F.sum("revenue")).alias("revenue")),
        "top_users": top_users.withColumn("revenue", _double(F.col("revenue"))),
        "unknown": enriched.agg(F.count(F.when(F.col("c_custkey").isNull(), 1)).alias("n_events")),
    })


# ------------------------------------------------------------------ PIP6 medallion

TIER_CHECKS = {
    "bronze": {"order_key_known": "o_orderkey IS NOT NULL", "date_in_range": "o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '2001-01-01'",
               "amount_at_least_10000": "o_totalprice >= 10000"},
    "silver": {"customer_in_credit": "in_credit IS NOT NULL"},
    "gold": {"has_orders": "n_orders > 0", "revenue_not_negative": "revenue >= 0"},
}


@register("medallion_report", ops=("PIP6", "DQ4", "DQ8"), oracle=f"""WITH {TGT_SQL}, {SRC_SQL},
bronze AS (SELECT *, 0 AS _batch FROM tgt UNION ALL SELECT *, 1 AS _batch FROM src),
silver AS (SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY updated_at DESC, _batch DESC) = 1),
daily AS (SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, count(*) AS n_orders, sum(o_totalprice) AS revenue FROM silver GROUP BY 1, 2),
first AS (SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, count(*) AS n_orders, sum(o_totalprice) AS revenue FROM tgt GROUP BY 1, 2),
gold AS (SELECT * FROM daily UNION ALL
         SELECT first.* FROM first ANTI JOIN daily ON first.order_date = daily.order_date AND first.o_orderstatus = daily.o_orderstatus),
c(tier, check_name, total, passed) AS (
SELECT 'bronze', 'order_key_known', count(*), count(o_orderkey) FROM bronze
UNION ALL SELECT 'bronze', 'date_in_range', count(*), count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2001-01-01') FROM bronze
UNION ALL SELECT 'bronze', 'amount_at_least_10000', count(*), count(*) FILTER (WHERE o_totalprice >= 10000) FROM bronze
UNION ALL SELECT 'silver', 'customer_in_credit', count(*), count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) FROM silver
UNION ALL SELECT 'gold', 'has_orders', count(*), count(*) FILTER (WHERE n_orders > 0) FROM gold
UNION ALL SELECT 'gold', 'revenue_not_negative', count(*), count(*) FILTER (WHERE revenue >= 0) FROM gold)
SELECT *, total - passed AS failed, round(CAST(passed AS DOUBLE) / total, 4) AS pass_rate FROM c
""")
def medallion_report(spark: SparkSession, sf: str) -> DataFrame:
    """Checks of the three tiers that one run of the medallion job wrote; a silver order whose customer is not among those in
    credit is an orphan."""
    base = medallion_job(spark, sf)
    tier = {"bronze": spark.read.parquet(f"{base}/bronze"), "silver": spark.read.parquet(f"{base}/silver"), "gold": spark.read.parquet(f"{base}/gold_v1")}
    in_credit = Tables(spark, sf).customer.filter("c_acctbal >= 0").select(F.col("c_custkey").alias("in_credit")).distinct()
    tier["silver"] = tier["silver"].join(in_credit, F.col("o_custkey") == F.col("in_credit"), "left")
    report = q.quality_report({name: (tier[name], checks) for name, checks in TIER_CHECKS.items()})
    report = written(report.withColumnRenamed("table_name", "tier"), f"{base}/report")
    return report.withColumn("failed", F.col("total") - F.col("passed"))


# ------------------------------------------------------------------ PIP1 retail

#: Dimensions of the retail job: table, key, renamed columns, the column whose values changed, its old value.
DIMENSIONS = {
    "products": ("part", "p_partkey", {"p_name": "product_name", "p_type": "product_type"}, "product_type"),
    "stores": ("supplier", "s_suppkey", {"s_name": "supplier_name", "s_nationkey": "store_nation"}, "supplier_name"),
    "customers": ("customer", "c_custkey", {"c_name": "customer_name", "c_mktsegment": "segment"}, "segment"),
}
LINE_EXPECTATIONS = {"positive_quantity": "l_quantity > 2", "positive_price": "l_extendedprice > 0"}


def dimension_changes(t: Tables, table: str, key: str, names: Mapping[str, str], changed: str) -> tuple[DataFrame, DataFrame]:
    """Fixture: two change files of a dimension. The first has an earlier state, in which every fifth row is missing
    and every third has the value 'OLD'; the second has the state of now, but for every seventh key, which did
    not change, and deletes for every eleventh."""
    now = getattr(t, table).select(F.col(key), *[F.col(c).alias(n) for c, n in names.items()])
    before = now.filter(F.col(key) % 5 != 0).withColumn(changed, F.when(F.col(key) % 3 == 0, F.lit("OLD")).otherwise(F.col(changed)))
    after = now.filter((F.col(key) % 7 != 0) | (F.col(key) % 5 == 0) | (F.col(key) % 3 == 0))
    op = F.when(F.col(key) % 11 == 0, "DELETE").otherwise("UPSERT")
    return (before.withColumn("change_no", F.lit(1)).withColumn("operation", F.lit("UPSERT")),
            after.withColumn("change_no", F.lit(2)).withColumn("operation", op))


def _dimension_sql(name: str) -> str:
    table, key, names, changed = DIMENSIONS[name]
    columns = ", ".join(f"{c} AS {n}" for c, n in names.items())
    raw = next(c for c, n in names.items() if n == changed)
    before, deleted = f"{key} % 5 <> 0", f"{key} % 11 = 0"
    after = f"({key} % 7 <> 0 OR {key} % 5 = 0 OR {key} % 3 = 0)"
    return f"""{name}_now AS (SELECT {key}, {columns} FROM {table} WHERE NOT ({after} AND {deleted})),
{name}_versions AS (SELECT count(*) FILTER (WHERE {before})
    + count(*) FILTER (WHERE {after} AND NOT {deleted} AND (NOT {before} OR {key} % 3 = 0 AND {raw} <> 'OLD')) AS n_versions FROM {table})"""


RETAIL_MARTS_CTE = f"""WITH lines AS (SELECT * FROM lineitem WHERE l_quantity > 2 AND l_extendedprice > 0),
{', '.join(_dimension_sql(d) for d in DIMENSIONS)},
facts AS (
  SELECT l.*, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price, o_custkey, CAST(o_orderdate AS DATE) AS day, p_partkey, product_name, product_type,
    s_suppkey, supplier_name, customer_name, segment, coalesce(l_returnflag = 'R', false) AS returned
  FROM lines l LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN products_now ON l_partkey = p_partkey
  LEFT JOIN stores_now ON l_suppkey = s_suppkey LEFT JOIN customers_now ON o_custkey = c_custkey),
sales AS (SELECT * FROM facts WHERE NOT returned)
"""
RETAIL_FIGURES = "sum(l_quantity) AS units, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS n_lines"


def retail_job(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Four bronze streams run side by side (lines with counted expectations, changes of products, stores and customers); the
    three change tables become type-2 histories by auto-CDC streams over bronze; sales and returns meet the
    current rows of all three in facts, from which the marts come."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "retail_job")
    t.lineitem.write.parquet(f"{base}/landing/lines")
    rules = {k: q.Rule(k, v) for k, v in LINE_EXPECTATIONS.items()}
    lines = spark.readStream.schema(t.lineitem.schema).parquet(f"{base}/landing/lines")
    lines = lines.observe("line_expectations", F.count(F.lit(1)).alias("total"), *[F.count(F.when(~r.holds(), 1)).alias(k) for k, r in rules.items()])
    streams = {"lines": (q.expect(lines, LINE_EXPECTATIONS, "drop"), f"{base}/bronze/lines", f"{base}/_checkpoint/lines")}
    for name, (table, key, names, changed) in DIMENSIONS.items():
        first, second = dimension_changes(t, table, key, names, changed)
        first.write.parquet(f"{base}/landing/{name}")
        second.write.mode("append").parquet(f"{base}/landing/{name}")
        changes = spark.readStream.schema(first.schema).parquet(f"{base}/landing/{name}")
        streams[name] = (fs.with_source_metadata(changes, name).drop("_ingested_at"), f"{base}/bronze/{name}", f"{base}/_checkpoint/{name}")
    done = drain_all(streams)

    failed = [(int(p["batchId"]), k, int(m[k]), int(m["total"])) for p in done["lines"].recentProgress
              for m in [p.get("observedMetrics", {}).get("line_expectations")] if m for k in rules]
    counts = written(spark.createDataFrame(failed, "batch long, rule string, failed long, total long"), f"{base}/bronze/line_expectations")

    current, versions = {}, None
    for name, (_, key, names, _) in DIMENSIONS.items():
        bronze = spark.read.parquet(f"{base}/bronze/{name}")
        feed = spark.readStream.schema(bronze.schema).parquet(f"{base}/bronze/{name}").select(key, *names.values(), "change_no", "operation")
        history = auto_cdc_stream(feed, [key], "change_no", f"{base}/silver/{name}", f"{base}/_checkpoint/cdc_{name}", num_buckets=8,
                                  delete_when=F.col("operation") == "DELETE", except_cols=["operation"]).history()
        history = written(history, f"{base}/silver/{name}_history")
        current[name] = history.filter("__END_AT IS NULL").select(key, *names.values())
        n = history.agg(F.count(F.lit(1)).alias("n_versions")).select(F.lit(name).alias("dimension"), "*")
        versions = n if versions is None else versions.unionByName(n)

    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    facts = (spark.read.parquet(f"{base}/bronze/lines").withColumn("returned", returned)
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
             .join(current["products"], F.col("l_partkey") == F.col("p_partkey"), "left")
             .join(current["stores"], F.col("l_suppkey") == F.col("s_suppkey"), "left")
             .join(current["customers"], F.col("o_custkey") == F.col("c_custkey"), "left"))
    facts = written(facts, f"{base}/facts")
    sales, returns = facts.filter(~F.col("returned")), facts.filter("returned")

    def mart(name: str, df: DataFrame, *by: str) -> DataFrame:
        return written(df.groupBy(*by).agg(F.sum("l_quantity").alias("units"), _double(F.sum(_money("l_extendedprice"))).alias("revenue"),
                                           F.count(F.lit(1)).alias("n_lines")), f"{base}/mart_{name}")

    return {"product_sales": mart("products", sales, "p_partkey", "product_name", "product_type"),
            "store_days": mart("store_days", sales, "day", "s_suppkey", "supplier_name"),
            "customers": mart("customers", sales, "o_custkey", "customer_name", "segment"),
            "returns": mart("returns", returns, "product_type", "segment"),
            "versions": versions,
            "expectations": counts.groupBy("rule").agg(F.sum("failed").alias("n_failed"), F.sum("total").alias("n_total"))}


@register("retail_marts", ops=("PIP1", "SCD4", "DQ1"), oracle=f"""{RETAIL_MARTS_CTE}
SELECT 'product_sales' AS mart, * FROM (SELECT p_partkey, product_name, product_type, {RETAIL_FIGURES} FROM sales GROUP BY ALL)
UNION ALL BY NAME SELECT 'store_days' AS mart, * FROM (SELECT day, s_suppkey, supplier_name, {RETAIL_FIGURES} FROM sales GROUP BY ALL)
UNION ALL BY NAME SELECT 'customers' AS mart, * FROM (SELECT o_custkey, customer_name, segment, {RETAIL_FIGURES} FROM sales GROUP BY ALL)
UNION ALL BY NAME SELECT 'returns' AS mart, * FROM (SELECT product_type, segment, {RETAIL_FIGURES} FROM facts WHERE returned GROUP BY ALL)
UNION ALL BY NAME SELECT 'versions' AS mart, 'products' AS dimension, n_versions FROM products_versions
UNION ALL BY NAME SELECT 'versions' AS mart, 'stores' AS dimension, n_versions FROM stores_versions
UNION ALL BY NAME SELECT 'versions' AS mart, 'customers' AS dimension, n_versions FROM customers_versions
UNION ALL BY NAME SELECT 'expectations' AS mart, 'positive_quantity' AS rule, count(*) FILTER (WHERE NOT coalesce(l_quantity > 2, false)) AS n_failed, count(*) AS n_total FROM lineitem
UNION ALL BY NAME SELECT 'expectations' AS mart, 'positive_price' AS rule, count(*) FILTER (WHERE NOT coalesce(l_extendedprice > 0, false)) AS n_failed, count(*) AS n_total FROM lineitem
""")
def retail_marts(spark: SparkSession, sf: str) -> DataFrame:
    """All marts of one run of the retail job."""
    return stacked(retail_job(spark, sf))
