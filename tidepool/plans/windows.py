"""Window functions (survey 2.5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import relational as rel
from ..operators.scan import keyed_running
from ..operators.windows import rfm_scores, sessionize
from ..sources.tables import Tables
from .registry import register

LINE_ORDER_DESC = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("dedup_latest", ops=("WIN1",), oracle="""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
           l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
           l_linestatus DESC) = 1
""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Keep the latest version of each (order, line) key: a row-number window, with few rows a key."""
    li = Tables(spark, sf).lineitem
    return rel.latest_per_key(li, ["l_orderkey", "l_linenumber"], LINE_ORDER_DESC)


@register("rank_vs_dense", ops=("WIN2",), oracle="""
WITH c AS (SELECT c.c_custkey, c.c_nationkey, count(*) AS n_orders
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           GROUP BY c.c_custkey, c.c_nationkey)
SELECT c_custkey, c_nationkey, n_orders,
       rank() OVER (PARTITION BY c_nationkey ORDER BY n_orders DESC) AS order_rank,
       dense_rank() OVER (PARTITION BY c_nationkey ORDER BY n_orders DESC) AS order_dense_rank
FROM c
""")
def rank_vs_dense(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    c = counts.join(t.customer.select("c_custkey", "c_nationkey"),
                    F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    r = keyed_running(c, ["c_nationkey"], [("n_orders", "desc"), "c_custkey"], rank="order_rank",
                      dense_rank="order_dense_rank", rank_by=1)
    return r.select("c_custkey", "c_nationkey", "n_orders", "order_rank", "order_dense_rank")


@register("lag_change", ops=("WIN3", "WIN14"), oracle="""
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  round(sum(o_totalprice), 2) AS spend
           FROM orders GROUP BY 1, 2)
SELECT o_custkey, month, spend,
       lag(spend) OVER (PARTITION BY o_custkey ORDER BY month) AS prev_spend,
       round(spend - lag(spend) OVER (PARTITION BY o_custkey ORDER BY month), 2) AS change
FROM m
""")
def lag_change(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    m = o.groupBy("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")) \
         .agg(rnd(F.sum("o_totalprice"), 2).alias("spend"))
    w = Window.partitionBy("o_custkey").orderBy("month")
    prev = F.lag("spend").over(w)
    return m.select("o_custkey", "month", "spend", prev.alias("prev_spend"),
                    rnd(F.col("spend") - prev, 2).alias("change"))


@register("running_total", ops=("WIN4",), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice,
       round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_total
FROM orders
""")
def running_total(spark: SparkSession, sf: str) -> DataFrame:
    """Running total per customer; a hot customer is spread over many tasks (``keyed_running``)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    r = keyed_running(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], sums=[("o_totalprice", "_rt")])
    return r.select("o_orderkey", "o_custkey", "o_totalprice", rnd("_rt", 2).alias("running_total"))


@register("ntile_quartiles", ops=("WIN5",), oracle="""
WITH s AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total_spend FROM orders GROUP BY 1)
SELECT o_custkey, total_spend,
       ntile(4) OVER (ORDER BY total_spend DESC, o_custkey) AS spend_quartile
FROM s
""")
def ntile_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Global quartiles without a single-partition window (see ``global_ntile``)."""
    o = Tables(spark, sf).orders
    s = o.groupBy("o_custkey").agg(rnd(F.sum("o_totalprice"), 2).alias("total_spend"))
    return rel.global_ntile(s, 4, [F.col("total_spend").desc(), F.col("o_custkey").asc()],
                            "spend_quartile")


@register("first_last_value", ops=("WIN6",), oracle="""
SELECT o_orderkey, o_custkey,
  first_value(o_totalprice) OVER w AS first_amount,
  last_value(o_totalprice) OVER w AS last_amount
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def first_last_value(spark: SparkSession, sf: str) -> DataFrame:
    """First/last over the full frame = per-key aggregates (partial aggregation)
    joined back on the key (AQE splits a skewed key on the join)."""
    o = Tables(spark, sf).orders
    ends = o.groupBy("o_custkey").agg(
        F.min_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("first_amount"),
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_amount"))
    ends = ends.withColumnRenamed("o_custkey", "_key")  # a NULL customer is a group of its own
    return o.select("o_orderkey", "o_custkey").join(ends, F.col("o_custkey").eqNullSafe(F.col("_key"))) \
            .select("o_orderkey", "o_custkey", "first_amount", "last_amount")


@register("top_n_per_group", ops=("WIN7",), oracle="""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2
""")
def top_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """row_number() <= 2: Spark inserts a partial WindowGroupLimit before the shuffle."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return rel.top_n_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2)


@register("sessionize", ops=("WIN8", "FUN7"), oracle="""
WITH g AS (
  SELECT event_id, user_id, ts,
    (CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT)) / 60.0 AS gap_min
  FROM events)
SELECT event_id, user_id,
  sum(CASE WHEN gap_min IS NULL OR gap_min > 30 THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS session_num
FROM g
""")
def sessionize_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    out = sessionize(ev, "user_id", "ts", "event_id", gap_minutes=30)
    return out.select("event_id", "user_id", "session_num")


@register("rolling_7_30", ops=("WIN9",), oracle="""
WITH d AS (
  SELECT r.r_name AS region, CAST(o.o_orderdate AS DATE) AS day, round(sum(o.o_totalprice), 2) AS revenue
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2)
SELECT region, day, revenue,
  round(sum(revenue) OVER w7, 2) AS sum_7, round(sum(revenue) OVER w7, 2) / count(*) OVER w7 AS avg_7,
  round(sum(revenue) OVER w30, 2) AS sum_30, round(sum(revenue) OVER w30, 2) / count(*) OVER w30 AS avg_30
FROM d
WINDOW w7 AS (PARTITION BY region ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       w30 AS (PARTITION BY region ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
""")
def rolling_7_30(spark: SparkSession, sf: str) -> DataFrame:
    from .relational import customer_geo
    t = Tables(spark, sf)
    cust = customer_geo(t).select("c_custkey", F.col("r_name").alias("region"))
    d = (t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy("region", F.to_date("o_orderdate").alias("day"))
         .agg(rnd(F.sum("o_totalprice"), 2).alias("revenue")))
    base = Window.partitionBy("region").orderBy("day")
    w7, w30 = base.rowsBetween(-6, 0), base.rowsBetween(-29, 0)
    return d.select("region", "day", "revenue",
                    rnd(F.sum("revenue").over(w7), 2).alias("sum_7"),
                    (rnd(F.sum("revenue").over(w7), 2) / F.count(F.lit(1)).over(w7)).alias("avg_7"),
                    rnd(F.sum("revenue").over(w30), 2).alias("sum_30"),
                    (rnd(F.sum("revenue").over(w30), 2) / F.count(F.lit(1)).over(w30)).alias("avg_30"))


def _part_revenue(t: Tables) -> DataFrame:
    rev = t.lineitem.groupBy("l_partkey").agg(rnd(F.sum("l_extendedprice"), 2).alias("revenue"))
    return rev.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")) \
              .select("p_partkey", "p_type", "revenue")


@register("category_rank", ops=("WIN10",), oracle="""
WITH r AS (SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1)
SELECT p.p_partkey, p.p_type, r.revenue,
  rank() OVER (PARTITION BY p.p_type ORDER BY r.revenue DESC) AS revenue_rank,
  row_number() OVER (PARTITION BY p.p_type ORDER BY r.revenue DESC, p.p_partkey) AS revenue_row_number
FROM r JOIN part p ON p.p_partkey = r.l_partkey
""")
def category_rank(spark: SparkSession, sf: str) -> DataFrame:
    pr = _part_revenue(Tables(spark, sf))
    r = keyed_running(pr, ["p_type"], [("revenue", "desc"), "p_partkey"], rank="revenue_rank",
                      row_number="revenue_row_number", rank_by=1)
    return r.select("p_partkey", "p_type", "revenue", "revenue_rank", "revenue_row_number")


@register("market_share", ops=("WIN11", "WIN12"), oracle="""
WITH r AS (SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1),
s AS (
  SELECT p.p_partkey, p.p_type, r.revenue,
    rank() OVER (PARTITION BY p.p_type ORDER BY r.revenue DESC) AS revenue_rank,
    round(sum(r.revenue) OVER (PARTITION BY p.p_type), 2) AS category_revenue,
    round(sum(r.revenue) OVER (PARTITION BY p.p_type ORDER BY r.revenue DESC, p.p_partkey
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cum_revenue
  FROM r JOIN part p ON p.p_partkey = r.l_partkey)
SELECT p_partkey, p_type, revenue, revenue_rank, category_revenue,
  revenue / category_revenue * 100 AS market_share_pct,
  cum_revenue / category_revenue * 100 AS cumulative_share_pct,
  CASE WHEN revenue_rank <= 5 THEN 'Top Performer'
       WHEN revenue_rank <= 20 THEN 'Strong Performer'
       WHEN cum_revenue / category_revenue * 100 <= 80 THEN 'Average Performer'
       ELSE 'Underperformer' END AS performance_tier
FROM s
""")
def market_share(spark: SparkSession, sf: str) -> DataFrame:
    return performance_tiers(_part_revenue(Tables(spark, sf)))


def performance_tiers(pr: DataFrame) -> DataFrame:
    """Rank, share and running share of each part's revenue within its type, and its tier."""
    totals = pr.groupBy("p_type").agg(rnd(F.sum("revenue"), 2).alias("category_revenue"))
    r = keyed_running(pr, ["p_type"], [("revenue", "desc"), "p_partkey"], rank="revenue_rank",
                      sums=[("revenue", "_cum")], rank_by=1)
    totals = totals.withColumnRenamed("p_type", "_type")
    s = r.join(totals, F.col("p_type").eqNullSafe(F.col("_type"))).select(
        "p_partkey", "p_type", "revenue", "revenue_rank", "category_revenue", rnd("_cum", 2).alias("cum_revenue"))
    cum_pct = F.col("cum_revenue") / F.col("category_revenue") * 100
    # The tiers' labels and cut-offs.
    tier = (F.when(F.col("revenue_rank") <= 5, "Top Performer")
            .when(F.col("revenue_rank") <= 20, "Strong Performer")
            .when(cum_pct <= 80, "Average Performer")
            .otherwise("Underperformer"))
    return s.select("p_partkey", "p_type", "revenue", "revenue_rank", "category_revenue",
                    (F.col("revenue") / F.col("category_revenue") * 100).alias("market_share_pct"),
                    cum_pct.alias("cumulative_share_pct"), tier.alias("performance_tier"))


RFM_AS_OF = "2001-08-02"


@register("rfm_segments", ops=("WIN13", "AGG17"), oracle=f"""
WITH c AS (
  SELECT o_custkey,
    CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{RFM_AS_OF}') AS INTEGER) AS recency_days,
    count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary
  FROM orders GROUP BY 1),
s AS (
  SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, o_custkey) AS r_score,
            ntile(5) OVER (ORDER BY frequency, o_custkey) AS f_score,
            ntile(5) OVER (ORDER BY monetary, o_custkey) AS m_score
  FROM c)
SELECT o_custkey, recency_days, frequency, monetary, r_score, f_score, m_score,
  r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
       WHEN r_score + f_score + m_score >= 11 THEN 'Loyal Customers'
       WHEN r_score + f_score + m_score >= 9 THEN 'Potential Loyalists'
       WHEN r_score + f_score + m_score >= 7 THEN 'At Risk'
       WHEN r_score + f_score + m_score >= 5 THEN 'Hibernating'
       ELSE 'Lost' END AS customer_segment,
  CASE WHEN monetary >= 3000000 THEN 'High Value'
       WHEN monetary >= 1500000 THEN 'Medium Value'
       ELSE 'Low Value' END AS ltv_category
FROM s
""")
def rfm_segments(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    c = o.groupBy("o_custkey").agg(
        F.datediff(F.lit(RFM_AS_OF).cast("date"), F.to_date(F.max("o_orderdate"))).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        rnd(F.sum("o_totalprice"), 2).alias("monetary"))
    return rfm_scores(c, "o_custkey", high_value=3_000_000, medium_value=1_500_000)
