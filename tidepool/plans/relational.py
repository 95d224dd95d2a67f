"""Projections, joins, aggregations, sorts and set operations (survey 2.2-2.4, 2.6, 2.7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import relational as rel
from ..operators import sampling
from ..operators import sketches as sk
from ..session import scratch_path
from ..sources.tables import Tables
from .registry import register

# Fixed "today" for date arithmetic so results are reproducible.
ORDERS_AS_OF = "2001-08-02"


def customer_geo(t: Tables) -> DataFrame:
    """customer + nation + region (nation/region are fixed-size dimensions)."""
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))


# ---------------------------------------------------------------- 2.2 projections

@register("completed_with_tax", ops=("PRJ1",), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice,
       round(o_totalprice * 0.08, 2) AS tax,
       round(o_totalprice * 1.08, 2) AS total_with_tax
FROM orders WHERE o_orderstatus = 'F'
""")
def completed_with_tax(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return (o.filter(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_custkey", "o_totalprice",
                    rnd(F.col("o_totalprice") * 0.08, 2).alias("tax"),
                    rnd(F.col("o_totalprice") * 1.08, 2).alias("total_with_tax")))


@register("rename_cast", ops=("PRJ2", "PRJ3", "PRJ4"), oracle="""
SELECT l_orderkey AS order_key, l_linenumber AS line_number,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price,
       CAST(l_shipdate AS DATE) AS ship_date,
       l_returnflag AS return_flag
FROM lineitem
""")
def rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    renamed = li.withColumnsRenamed({
        "l_orderkey": "order_key", "l_linenumber": "line_number", "l_quantity": "quantity",
        "l_extendedprice": "extended_price", "l_shipdate": "ship_date", "l_returnflag": "return_flag"})
    typed = renamed.withColumns({
        "quantity": F.col("quantity").cast("int"),
        "extended_price": F.col("extended_price").cast("decimal(12,2)"),
        "ship_date": F.to_date("ship_date"),
    })
    return typed.drop("l_partkey", "l_suppkey", "l_discount", "l_tax", "l_linestatus")


@register("order_tier", ops=("PRJ5", "PRJ6"), oracle="""
SELECT o_orderkey,
  CASE WHEN o_totalprice >= 300000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'platinum'
       WHEN o_totalprice >= 300000 THEN 'gold'
       WHEN o_totalprice >= 100000 AND o_totalprice < 300000 THEN 'silver'
       WHEN o_totalprice IS NULL THEN 'unknown'
       ELSE 'bronze' END AS tier
FROM orders
""")
def order_tier(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    p = F.col("o_totalprice")
    tier = (F.when((p >= 300000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "platinum")
            .when(p >= 300000, "gold")
            .when((p >= 100000) & (p < 300000), "silver")
            .when(p.isNull(), "unknown")
            .otherwise("bronze"))
    return o.select("o_orderkey", tier.alias("tier"))


@register("sample_rows", ops=("PRJ13",))
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Bernoulli sample (fraction 0.1, fixed seed) - the sampling is the feature."""
    return Tables(spark, sf).orders.sample(fraction=0.1, seed=42)


SAMPLE_STRATUM, SAMPLE_SEED = 25, 42


@register("sample_strata", ops=("PRJ13",), oracle=f"""WITH r AS (
  SELECT o_orderkey, o_orderpriority, o_totalprice, count(*) OVER (PARTITION BY o_orderpriority) AS size,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('{SAMPLE_SEED}:' || o_orderkey), o_orderkey) AS rk
  FROM orders)
SELECT o_orderkey, o_orderpriority, o_totalprice,
  round(CAST(size AS DOUBLE) / least(size, {SAMPLE_STRATUM}), 6) AS weight
FROM r WHERE rk <= {SAMPLE_STRATUM}
""")
def sample_strata(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly 25 orders of each priority, the same on any partitioning, with the orders that each stands for."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    drawn = sampling.bottom_k(o, ["o_orderpriority"], ["o_orderkey"], SAMPLE_STRATUM, SAMPLE_SEED)
    return sampling.with_weights(drawn, o, ["o_orderpriority"]).withColumn("weight", rnd("weight", 6))


# ---------------------------------------------------------------- 2.3 joins

@register("inner_join", ops=("JOI1",), oracle="""
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, c.c_name, n.n_name,
       o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    c = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return (t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
            .select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    "c_name", "n_name", "o_totalprice"))


@register("left_join_coalesce", ops=("JOI2", "PRJ7", "JOI7"), oracle="""
WITH s AS (
  SELECT l_partkey, sum(l_quantity) AS units, count(*) AS n_lines
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' GROUP BY l_partkey)
SELECT p.p_partkey, p.p_name,
       coalesce(s.units, 0.0) AS units_2001,
       coalesce(s.n_lines, 0) AS lines_2001,
       CASE WHEN s.l_partkey IS NULL THEN 'no sales' ELSE 'sold' END AS sales_status
FROM part p LEFT JOIN s ON p.p_partkey = s.l_partkey
""")
def left_join_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    s = (t.lineitem.filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
         .groupBy("l_partkey")
         .agg(F.sum("l_quantity").alias("units"), F.count(F.lit(1)).alias("n_lines"),
              F.lit(True).alias("_hit")))
    j = t.part.join(s, F.col("p_partkey") == F.col("l_partkey"), "left")
    return j.select("p_partkey", "p_name",
                    F.coalesce("units", F.lit(0.0)).alias("units_2001"),
                    F.coalesce("n_lines", F.lit(0)).cast("long").alias("lines_2001"),
                    F.when(F.col("_hit").isNull(), "no sales").otherwise("sold").alias("sales_status"))


@register("anti_join_orphans", ops=("JOI3",), oracle="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderdate >= TIMESTAMP '2001-01-01')
""")
def anti_join_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with no order in 2001 (left anti join; NOT IN's NULL trap avoided)."""
    t = Tables(spark, sf)
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return (t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
            .select("c_custkey", "c_name"))


@register("semi_join", ops=("JOI4",), oracle="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
              AND o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 400000)
""")
def semi_join(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    big_urgent = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
    return (t.customer.join(big_urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
            .select("c_custkey", "c_name"))


@register("self_join_pairs", ops=("JOI5",), oracle="""
SELECT o1.o_custkey, CAST(o1.o_orderdate AS DATE) AS order_date,
       o1.o_orderkey AS order_key_1, o2.o_orderkey AS order_key_2,
       o1.o_totalprice AS amount_1, o2.o_totalprice AS amount_2
FROM orders o1 JOIN orders o2
  ON o1.o_custkey = o2.o_custkey AND o1.o_orderdate = o2.o_orderdate
 AND o1.o_orderkey < o2.o_orderkey
WHERE o1.o_custkey IS NOT NULL
""")
def self_join_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Same-customer same-day order pairs, each unordered pair once.

    The equi part is the composite (customer, day) key, so the pairs come only
    from orders one customer placed on one day; the ``<`` residual drops the
    mirrored pair and the self pair.
    """
    o = Tables(spark, sf).orders.filter(F.col("o_custkey").isNotNull()) \
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    a, b = o.alias("a"), o.alias("b")
    cond = ((F.col("a.o_custkey") == F.col("b.o_custkey"))
            & (F.col("a.o_orderdate") == F.col("b.o_orderdate"))
            & (F.col("a.o_orderkey") < F.col("b.o_orderkey")))
    return a.join(b, cond).select(
        F.col("a.o_custkey").alias("o_custkey"), F.to_date("a.o_orderdate").alias("order_date"),
        F.col("a.o_orderkey").alias("order_key_1"), F.col("b.o_orderkey").alias("order_key_2"),
        F.col("a.o_totalprice").alias("amount_1"), F.col("b.o_totalprice").alias("amount_2"))


LINE_TOTAL_ORDER = ["l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("multi_join_top_line", ops=("JOI6", "JOI10"), oracle="""
SELECT o.o_orderkey, c.c_name, p.p_name, l.l_extendedprice AS top_line_price
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
QUALIFY row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_extendedprice DESC,
  l.l_linenumber DESC, l.l_partkey DESC, l.l_suppkey DESC, l.l_quantity DESC, l.l_discount DESC,
  l.l_tax DESC, l.l_returnflag DESC, l.l_linestatus DESC, l.l_shipdate DESC) = 1
""")
def multi_join_top_line(spark: SparkSession, sf: str) -> DataFrame:
    """Four-table chain, one row per order: its most expensive line.

    The pick is an aggregate (max_by over the tie-broken order), reduced
    map-side before the shuffle instead of a window over whole orders.
    """
    t = Tables(spark, sf)
    top = rel.latest_per_key(t.lineitem, ["l_orderkey"], LINE_TOTAL_ORDER)
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(top, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.part, F.col("p_partkey") == F.col("l_partkey")))
    return j.select("o_orderkey", "c_name", "p_name", F.col("l_extendedprice").alias("top_line_price"))


@register("having_high_value", ops=("AGG2", "JOI7"), oracle="""
WITH s AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total
           FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 3000000)
SELECT c.c_custkey, c.c_name, s.n_orders, round(s.total, 2) AS total_spend
FROM s JOIN customer c ON c.c_custkey = s.o_custkey
""")
def having_high_value(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    s = (t.orders.groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"))
         .filter(F.col("total") > 3000000))
    return (s.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", "c_name", "n_orders", rnd("total", 2).alias("total_spend")))


@register("broadcast_join", ops=("JOI9", "JOI10"), oracle="""
SELECT s.s_suppkey, s.s_name, n.n_name AS supplier_nation, r.r_name AS supplier_region
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def broadcast_join(spark: SparkSession, sf: str) -> DataFrame:
    """Dimension join with an explicit broadcast of a size-checked side."""
    t = Tables(spark, sf)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    geo = rel.sized_broadcast(geo)
    return (t.supplier.join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "s_name", F.col("n_name").alias("supplier_nation"),
                    F.col("r_name").alias("supplier_region")))


# ---------------------------------------------------------------- 2.4 aggregations

@register("daily_region_summary", ops=("AGG1",), oracle="""
SELECT CAST(o.o_orderdate AS DATE) AS order_date, r.r_name AS region,
       count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue,
       round(sum(o.o_totalprice), 2) / count(*) AS avg_order,
       min(o.o_totalprice) AS min_order, max(o.o_totalprice) AS max_order
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""")
def daily_region_summary(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    # Narrow the customer side to (key, region) before it is shuffled for the join.
    cust = customer_geo(t).select("c_custkey", F.col("r_name").alias("region"))
    j = t.orders.select("o_custkey", "o_orderdate", "o_totalprice") \
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return (j.groupBy(F.to_date("o_orderdate").alias("order_date"), "region")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 rnd(F.sum("o_totalprice"), 2).alias("revenue"),
                 (rnd(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("avg_order"),
                 F.min("o_totalprice").alias("min_order"),
                 F.max("o_totalprice").alias("max_order")))


@register("rollup_region_tier", ops=("AGG3",), oracle="""
SELECT r.r_name AS region, c.c_mktsegment AS tier,
       CAST(GROUPING(r.r_name, c.c_mktsegment) AS BIGINT) AS grouping_level,
       count(*) AS n_customers, round(sum(c.c_acctbal), 2) AS total_balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY ROLLUP (r.r_name, c.c_mktsegment)
""")
def rollup_region_tier(spark: SparkSession, sf: str) -> DataFrame:
    c = customer_geo(Tables(spark, sf))
    return (c.rollup(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("tier"))
            .agg(F.grouping_id().cast("long").alias("grouping_level"),
                 F.count(F.lit(1)).alias("n_customers"),
                 rnd(F.sum("c_acctbal"), 2).alias("total_balance")))


@register("cube_region_status", ops=("AGG4",), oracle="""
SELECT r.r_name AS region, o.o_orderstatus AS status,
       CAST(GROUPING(r.r_name, o.o_orderstatus) AS BIGINT) AS grouping_level,
       count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY CUBE (r.r_name, o.o_orderstatus)
""")
def cube_region_status(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    cust = customer_geo(t).select("c_custkey", "r_name")
    j = t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return (j.cube(F.col("r_name").alias("region"), F.col("o_orderstatus").alias("status"))
            .agg(F.grouping_id().cast("long").alias("grouping_level"),
                 F.count(F.lit(1)).alias("n_orders"),
                 rnd(F.sum("o_totalprice"), 2).alias("revenue")))


@register("approx_products", ops=("AGG6",))
def approx_products(spark: SparkSession, sf: str) -> DataFrame:
    """HyperLogLog++ distinct count (approximate, so rows-only check)."""
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("approx_parts"))


@register("weekly_users_from_sketches", ops=("AGG6",), oracle="""WITH d AS (
  SELECT DISTINCT CAST(ts AS DATE) AS day, event_type, user_id FROM events),
days AS (SELECT DISTINCT day, event_type FROM d),
n AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
u AS (SELECT x.day, x.event_type, count(DISTINCT d.user_id) AS users
      FROM days x JOIN d ON d.event_type = x.event_type AND d.day BETWEEN x.day - 6 AND x.day GROUP BY 1, 2),
e AS (SELECT x.day, x.event_type, CAST(sum(n.n) AS BIGINT) AS n_rows
      FROM days x JOIN n ON n.event_type = x.event_type AND n.day BETWEEN x.day - 6 AND x.day GROUP BY 1, 2)
SELECT day, event_type, n_rows, users, true AS estimate_in_bound FROM u JOIN e USING (day, event_type)
""")
def weekly_users_from_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Users of the trailing seven days, merged from a stored sketch a day, beside the exact count.

    The days are stored in two loads, the second of which repeats one day of the first.
    """
    ev = Tables(spark, sf).events.select(F.to_date("ts").alias("day"), "event_type", "user_id")
    path = scratch_path(spark, "user_sketches")
    cut = F.lit("2024-01-16").cast("date")
    for load in (ev.filter(F.col("day") <= cut), ev.filter(F.col("day") >= cut)):
        sk.store_daily(load, path, "day", ["event_type"], {"users_sketch": "user_id"})
    weeks = sk.trailing_days(spark.read.parquet(path), "day", ["event_type"], ["users_sketch"], 7)
    exact = (ev.distinct().withColumn("day", F.explode(F.expr("sequence(day, date_add(day, 6))")))
             .groupBy("day", "event_type").agg(F.countDistinct("user_id").alias("users")))
    off = F.abs(F.hll_sketch_estimate("users_sketch") - F.col("users"))
    return weeks.join(exact, ["day", "event_type"]).select(
        "day", "event_type", "n_rows", "users",
        (off <= F.ceil(F.col("users") * sk.relative_error(sigmas=4))).alias("estimate_in_bound"))


@register("salted_product_funnel", ops=("AGG7", "AGG8"), oracle="""
SELECT user_id,
       count(*) FILTER (WHERE event_type = 'view') AS views,
       count(*) FILTER (WHERE event_type = 'click') AS clicks,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS purchase_value,
       round(CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE)
             / nullif(count(*) FILTER (WHERE event_type = 'view'), 0), 4) AS view_to_purchase
FROM events GROUP BY user_id
""")
def salted_product_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Funnel counters per user with a two-stage salted aggregation."""
    ev = Tables(spark, sf).events
    is_t = lambda t: F.col("event_type") == t
    partial = {
        "v": F.count(F.when(is_t("view"), 1)),
        "c": F.count(F.when(is_t("click"), 1)),
        "p": F.count(F.when(is_t("purchase"), 1)),
        "pv": F.sum(F.when(is_t("purchase"), F.col("value")).otherwise(0.0)),
    }
    final = {
        "views": F.sum("v"), "clicks": F.sum("c"), "purchases": F.sum("p"), "pv": F.sum("pv"),
    }
    out = rel.salted_agg(ev, ["user_id"], partial, final, salt_by=["event_id"], buckets=8)
    return out.select(
        "user_id", "views", "clicks", "purchases",
        rnd("pv", 2).alias("purchase_value"),
        rnd(F.try_divide(F.col("purchases").cast("double"),
                             F.when(F.col("views") != 0, F.col("views"))), 4).alias("view_to_purchase"))


@register("pivot_status", ops=("AGG9",), oracle="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS status_f,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS status_o,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS status_p,
       count(*) FILTER (WHERE o_orderstatus = 'X') AS status_x
FROM orders GROUP BY 1
""")
def pivot_status(spark: SparkSession, sf: str) -> DataFrame:
    """Pivot with a fixed value list (one pass; 'X' never occurs and gives 0)."""
    o = Tables(spark, sf).orders
    p = (o.groupBy(F.year("o_orderdate").alias("order_year"))
         .pivot("o_orderstatus", ["F", "O", "P", "X"]).count().fillna(0))
    return p.select("order_year", *[F.col(s).cast("long").alias(f"status_{s.lower()}") for s in "FOPX"])


@register("daily_category_summary", ops=("AGG13",), oracle="""
SELECT CAST(l.l_shipdate AS DATE) AS ship_date, p.p_type,
       count(*) AS n_lines,
       round(sum(l.l_extendedprice * (1 - l.l_discount)), 4) AS revenue,
       round(sum(l.l_discount), 2) / count(*) AS avg_discount,
       round(CAST(count(*) FILTER (WHERE l.l_returnflag = 'R') AS DOUBLE) / count(*), 4) AS return_rate
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2
""")
def daily_category_summary(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    j = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return (j.groupBy(F.to_date("l_shipdate").alias("ship_date"), "p_type")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 rnd(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
                 (rnd(F.sum("l_discount"), 2) / F.count(F.lit(1))).alias("avg_discount"),
                 rnd(F.try_divide(F.count(F.when(F.col("l_returnflag") == "R", 1)).cast("double"),
                                      F.count(F.lit(1))), 4).alias("return_rate")))


@register("customer_ltv", ops=("AGG15", "FUN5", "FUN6"), oracle=f"""
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS lifetime_value,
       round(sum(o_totalprice), 2) / count(*) AS avg_order_value,
       CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order,
       CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS INTEGER) AS days_since_last,
       CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS INTEGER) AS tenure_days
FROM orders GROUP BY o_custkey
""")
def customer_ltv(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    as_of = F.lit(ORDERS_AS_OF).cast("date")
    g = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        rnd(F.sum("o_totalprice"), 2).alias("lifetime_value"),
        (rnd(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("avg_order_value"),
        F.to_date(F.min("o_orderdate")).alias("first_order"),
        F.to_date(F.max("o_orderdate")).alias("last_order"))
    return g.withColumns({
        "days_since_last": F.datediff(as_of, F.col("last_order")),
        "tenure_days": F.datediff(F.col("last_order"), F.col("first_order")),
    })


@register("product_performance", ops=("AGG16", "AGG5"), oracle="""
SELECT p.p_partkey, p.p_name, sum(l.l_quantity) AS units,
       round(sum(l.l_extendedprice), 2) AS gross_revenue,
       count(DISTINCT l.l_orderkey) AS n_orders,
       round(sum(l.l_extendedprice), 2) / sum(l.l_quantity) AS avg_unit_price,
       round(CAST(count(*) FILTER (WHERE l.l_returnflag = 'R') AS DOUBLE) / count(*), 4) AS return_ratio
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_partkey, p.p_name
""")
def product_performance(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    # Aggregate the fact first, then join the (smaller) per-part result to part.
    g = t.lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("units"),
        F.sum("l_extendedprice").alias("gross"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_ret"),
        F.count(F.lit(1)).alias("n"))
    j = g.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return j.select("p_partkey", "p_name", "units",
                    rnd("gross", 2).alias("gross_revenue"), "n_orders",
                    F.try_divide(rnd("gross", 2), F.col("units")).alias("avg_unit_price"),
                    rnd(F.col("n_ret") / F.col("n"), 4).alias("return_ratio"))


@register("sar_prefill", ops=("AGG18",), oracle="""
SELECT user_id, count(*) AS n_events,
       count(*) FILTER (WHERE value > 45) AS n_high_value,
       round(sum(value), 2) AS total_value, max(value) AS max_value
FROM events GROUP BY user_id
HAVING count(*) FILTER (WHERE value > 45) >= 3
""")
def sar_prefill(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    g = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(F.col("value") > 45, 1)).alias("n_high_value"),
        rnd(F.sum("value"), 2).alias("total_value"),
        F.max("value").alias("max_value"))
    return g.filter(F.col("n_high_value") >= 3)


@register("duplicate_keys", ops=("AGG20",), oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS n
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return (li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


@register("collect_products", ops=("AGG11", "ARR6"), oracle="""
SELECT l_orderkey,
       array_to_string(list_sort(list_distinct(list(l_partkey))), ',') AS parts,
       array_to_string(list_sort(list(l_partkey)), ',') AS parts_with_repeats,
       CAST(count(DISTINCT l_partkey) AS INTEGER) AS n_parts
FROM lineitem GROUP BY l_orderkey
""")
def collect_products(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    g = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_partkey")).alias("part_set"),
        F.array_sort(F.collect_list("l_partkey")).alias("part_list"))
    return g.select("l_orderkey",
                    F.array_join(g.part_set.cast("array<string>"), ",").alias("parts"),
                    F.array_join(g.part_list.cast("array<string>"), ",").alias("parts_with_repeats"),
                    F.size(F.array_distinct("part_list")).alias("n_parts"))


# ---------------------------------------------------------------- 2.6 sorts, limits

@register("category_revenue_sorted", ops=("SRT1",), oracle="""
SELECT p.p_type, p.p_size, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2 ORDER BY revenue DESC, p_type, p_size
""")
def category_revenue_sorted(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    g = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("rev"))
    j = g.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return (j.groupBy("p_type", "p_size").agg(rnd(F.sum("rev"), 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "p_type", "p_size"))


@register("top_k_customers", ops=("SRT2", "SRT4"), oracle="""
SELECT c.c_custkey, c.c_name, round(s.total, 2) AS total_spend
FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey) s
JOIN customer c ON c.c_custkey = s.o_custkey
ORDER BY s.total DESC, c.c_custkey LIMIT 10
""")
def top_k_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Top 10 by spend: orderBy+limit plans a TakeOrderedAndProject (per-task top-k)."""
    t = Tables(spark, sf)
    s = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    top = s.orderBy(F.desc("total"), F.asc("o_custkey")).limit(10)
    return (top.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", "c_name", rnd("total", 2).alias("total_spend")))


@register("top_k_latest_day", ops=("SRT3", "PRJ12", "PRJ15"), oracle="""
SELECT o_custkey, round(sum(o_totalprice), 2) AS day_spend
FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
GROUP BY o_custkey ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 10
""")
def top_k_latest_day(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    o.createOrReplaceTempView("tp_orders")
    return spark.sql("""
        SELECT o_custkey, round(sum(o_totalprice), 2) AS day_spend
        FROM tp_orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM tp_orders)
        GROUP BY o_custkey ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 10""")


# ---------------------------------------------------------------- 2.7 set operations

@register("intersect_customers", ops=("SET5",), oracle="""
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995
INTERSECT
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001
""")
def intersect_customers(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    a = o.filter(F.year("o_orderdate") == 1995).select("o_custkey")
    b = o.filter(F.year("o_orderdate") == 2001).select("o_custkey")
    return a.intersect(b)


# ---------------------------------------------------------------- star schema, day windows

@register("denormalized_facts", ops=("JOI12",), oracle="""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
       o.o_orderstatus AS order_status, CAST(o.o_orderdate AS DATE) AS order_date,
       p.p_name AS product_name, p.p_type AS product_type,
       s.s_name AS supplier_name, s.s_nationkey AS supplier_nationkey
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def denormalized_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows with three dimensions left-joined under prefixed names (no row is lost)."""
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey"), F.col("o_orderstatus").alias("order_status"),
                        F.to_date("o_orderdate").alias("order_date"))
    p = t.part.select("p_partkey", F.col("p_name").alias("product_name"), F.col("p_type").alias("product_type"))
    s = t.supplier.select("s_suppkey", F.col("s_name").alias("supplier_name"),
                          F.col("s_nationkey").alias("supplier_nationkey"))
    f = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    j = (f.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
         .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left"))
    return j.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "order_status", "order_date",
                    "product_name", "product_type", "supplier_name", "supplier_nationkey")


@register("daily_store_sales", ops=("AGG5", "AGG14"), oracle="""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2, 3
""")
def daily_store_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Batch day windows with an exact distinct count."""
    ev = Tables(spark, sf).events
    g = ev.groupBy(F.window("ts", "1 day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"),
        rnd(F.sum("value"), 2).alias("total_value"))
    return g.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                    "event_type", "n_events", "n_users", "total_value")


@register("unpivot_metrics", ops=("AGG10", "PRJ16"), oracle="""
WITH m AS (SELECT o_custkey, count(*) AS n_orders,
                  count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open,
                  count(*) FILTER (WHERE o_orderstatus = 'P') AS n_pending,
                  round(sum(o_totalprice), 2) AS total_revenue
           FROM orders GROUP BY 1)
SELECT * FROM (
  SELECT o_custkey, 'n_orders' AS metric, CAST(n_orders AS DOUBLE) AS value FROM m
  UNION ALL SELECT o_custkey, 'n_open', CAST(n_open AS DOUBLE) FROM m
  UNION ALL SELECT o_custkey, 'n_pending', CAST(n_pending AS DOUBLE) FROM m
  UNION ALL SELECT o_custkey, 'total_revenue', total_revenue FROM m)
WHERE value <> 0
""")
def unpivot_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Wide metrics per customer to long form (zeros dropped), via selectExpr + stack."""
    o = Tables(spark, sf).orders
    m = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("n_open"),
        F.count(F.when(F.col("o_orderstatus") == "P", 1)).alias("n_pending"),
        rnd(F.sum("o_totalprice"), 2).alias("total_revenue"))
    long = m.selectExpr(
        "o_custkey",
        "stack(4, 'n_orders', CAST(n_orders AS DOUBLE), 'n_open', CAST(n_open AS DOUBLE), "
        "'n_pending', CAST(n_pending AS DOUBLE), 'total_revenue', total_revenue) AS (metric, value)")
    return long.filter(F.expr("value <> 0"))


@register("time_arith", ops=("FUN8", "FUN9", "FUN5"), oracle="""
SELECT event_id,
  ts + INTERVAL 90 MINUTE AS due_at,
  strftime(TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts)) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS ts_text,
  CAST(ts AS DATE) AS event_date,
  coalesce(CASE WHEN value > 45 THEN NULL ELSE event_type END, 'unknown') AS type_or_default,
  (CASE WHEN value > 45 THEN NULL ELSE event_type END) IS NOT DISTINCT FROM event_type AS unchanged
FROM events
""")
def time_arith(spark: SparkSession, sf: str) -> DataFrame:
    """Interval addition, epoch seconds back to text, dates, coalesce and NULL-safe equality."""
    ev = Tables(spark, sf).events
    masked = F.when(F.col("value") > 45, F.lit(None)).otherwise(F.col("event_type"))
    return ev.select("event_id",
                     (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("due_at"),
                     F.from_unixtime(F.unix_timestamp(F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss")
                     .alias("ts_text"),
                     F.to_date("ts").alias("event_date"),
                     F.coalesce(masked, F.lit("unknown")).alias("type_or_default"),
                     masked.eqNullSafe(F.col("event_type")).alias("unchanged"))


@register("append_literal_rows", ops=("SNK3", "SNK2"), oracle="""
SELECT r_regionkey, r_name FROM region
UNION ALL SELECT 100, 'ANTARCTICA'
UNION ALL SELECT 101, 'OCEANIA'
""")
def append_literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Write a table, then INSERT literal rows into it (append)."""
    from ..session import scratch_path
    path = scratch_path(spark, "append_literal")
    Tables(spark, sf).region.write.parquet(path)
    spark.createDataFrame([(100, "ANTARCTICA"), (101, "OCEANIA")], "r_regionkey int, r_name string") \
         .write.mode("append").parquet(path)
    return spark.read.parquet(path)
