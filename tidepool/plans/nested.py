"""Scalar, array, map, struct, JSON functions and UDFs (survey 2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import explode_struct_array, nest
from ..functions.numeric import rnd
from ..functions.udfs import categorize_udf, classify_payload_native, classify_payload_udf
from ..sources.tables import Tables
from .registry import register


@register("clean_strings", ops=("FUN1",), oracle="""
SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower,
  array_to_string(list_transform(string_split(p_name, ' '),
                  lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ') AS name_title,
  trim('  ' || p_type || '  ') AS type_trimmed,
  concat(p_brand, '-', p_type, '-', CAST(p_size AS VARCHAR)) AS sku
FROM part
""")
def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    p = Tables(spark, sf).part
    return p.select("p_partkey", F.upper("p_name").alias("name_upper"),
                    F.lower("p_brand").alias("brand_lower"),
                    F.initcap("p_name").alias("name_title"),
                    F.trim(F.concat(F.lit("  "), "p_type", F.lit("  "))).alias("type_trimmed"),
                    F.concat("p_brand", F.lit("-"), "p_type", F.lit("-"),
                             F.col("p_size").cast("string")).alias("sku"))


@register("hash_key", ops=("FUN3", "FUN10"), oracle="""
SELECT o_orderkey,
  md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                o_orderpriority)) AS row_hash,
  substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS short_key,
  substr(o_orderpriority, 1, 1) AS priority_code
FROM orders
""")
def hash_key(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return o.select("o_orderkey",
                    F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"),
                                      F.col("o_custkey").cast("string"), "o_orderstatus",
                                      "o_orderpriority")).alias("row_hash"),
                    F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8).alias("short_key"),
                    F.substring("o_orderpriority", 1, 1).alias("priority_code"))


@register("returns_split", ops=("FUN4",), oracle="""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'sale' END AS kind,
  CASE WHEN l_returnflag = 'R' THEN -round(l_extendedprice * (1 - l_discount), 2)
       ELSE round(l_extendedprice * (1 - l_discount), 2) END AS signed_amount,
  abs(CASE WHEN l_returnflag = 'R' THEN -round(l_extendedprice * (1 - l_discount), 2)
       ELSE round(l_extendedprice * (1 - l_discount), 2) END) AS abs_amount,
  CAST(floor(l_quantity / 10) AS BIGINT) AS qty_bucket
FROM lineitem
""")
def returns_split(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    net = rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2)
    is_ret = F.col("l_returnflag") == "R"
    signed = F.when(is_ret, -net).otherwise(net)
    return li.select("l_orderkey", "l_linenumber",
                     F.when(is_ret, "return").otherwise("sale").alias("kind"),
                     signed.alias("signed_amount"), F.abs(signed).alias("abs_amount"),
                     F.floor(F.col("l_quantity") / 10).cast("long").alias("qty_bucket"))


def nested_orders(t: Tables) -> DataFrame:
    """Orders with their lines as an array of structs (the nested sales shape)."""
    lines = nest(t.lineitem, ["l_orderkey"], ["l_partkey", "l_quantity", "l_extendedprice"], "line_items")
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


@register("explode_lines", ops=("ARR1",), oracle="""
SELECT o.o_orderkey, o.o_custkey, l.l_partkey, l.l_quantity, l.l_extendedprice
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def explode_lines(spark: SparkSession, sf: str) -> DataFrame:
    """explode drops orders whose line array is NULL or empty."""
    n = nested_orders(Tables(spark, sf)).select("o_orderkey", "o_custkey", "line_items")
    return explode_struct_array(n, "line_items")


@register("explode_outer_tags", ops=("ARR2",), oracle="""
WITH tags AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders
              WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderpriority LIKE '1-%')
SELECT c.c_custkey, t.o_orderpriority AS tag
FROM customer c LEFT JOIN tags t ON t.o_custkey = c.c_custkey
""")
def explode_outer_tags(spark: SparkSession, sf: str) -> DataFrame:
    """NULL arrays (no 2001 orders) and empty arrays (no urgent ones) each give one NULL row."""
    t = Tables(spark, sf)
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    per_cust = recent.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("all_tags"))
    tagged = (t.customer.select("c_custkey")
              .join(per_cust, F.col("c_custkey") == F.col("o_custkey"), "left")
              .select("c_custkey", F.filter("all_tags", lambda x: x.startswith("1-")).alias("tags")))
    return tagged.select("c_custkey", F.explode_outer("tags").alias("tag"))


@register("array_hof", ops=("ARR3", "ARR4", "ARR5"), oracle="""
SELECT vec_id,
  CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
  round(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_filter(embedding, lambda x: x > 0), lambda x: x::DOUBLE)),
        lambda a, b: a + b), 4) AS positive_sum,
  CAST(list_max(list_transform(embedding, lambda x: x::DOUBLE * 2)) AS DOUBLE) AS max_doubled,
  CAST(embedding[1] AS DOUBLE) AS first_component
FROM embeddings
""")
def array_hof(spark: SparkSession, sf: str) -> DataFrame:
    e = Tables(spark, sf).embeddings
    pos = F.filter("embedding", lambda x: x > 0)
    return e.select("vec_id", F.size(pos).alias("n_positive"),
                    rnd(F.aggregate(pos, F.lit(0.0), lambda acc, x: acc + x.cast("double")), 4)
                    .alias("positive_sum"),
                    F.array_max(F.transform("embedding", lambda x: x.cast("double") * 2)).alias("max_doubled"),
                    F.element_at("embedding", 1).cast("double").alias("first_component"))


@register("map_ops", ops=("MAP1",), oracle="""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id,
  array_to_string(list_sort(list(event_type)), ',') AS event_types,
  CAST(count(*) AS INTEGER) AS n_types,
  max(CASE WHEN event_type = 'purchase' THEN n END) AS purchases,
  max(CASE WHEN event_type = 'refund' THEN n END) AS refunds,
  CAST(sum(n) AS BIGINT) AS total_events
FROM c GROUP BY user_id
""")
def map_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Build a map per user, then read it with map_keys / element_at / size / map_values."""
    ev = Tables(spark, sf).events
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("type_counts"))
    return m.select("user_id",
                    F.array_join(F.array_sort(F.map_keys("type_counts")), ",").alias("event_types"),
                    F.size("type_counts").alias("n_types"),
                    F.element_at("type_counts", F.lit("purchase")).alias("purchases"),
                    F.element_at("type_counts", F.lit("refund")).alias("refunds"),
                    F.aggregate(F.map_values("type_counts"), F.lit(0).cast("long"),
                                lambda a, x: a + x).alias("total_events"))


@register("parse_json_props", ops=("JSN1", "JSN3"), oracle="""
SELECT event_id,
  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_typed,
  json_extract_string(props, '$.k') AS k_text
FROM events
""")
def parse_json_props(spark: SparkSession, sf: str) -> DataFrame:
    """from_json with a DDL schema (typed, NULL on malformed) and get_json_object (untyped)."""
    ev = Tables(spark, sf).events
    return ev.select("event_id",
                     F.from_json("props", "k INT").getField("k").alias("k_typed"),
                     F.get_json_object("props", "$.k").alias("k_text"))


@register("flatten_two_level", ops=("JSN2", "STR1"), oracle="""
SELECT c.c_custkey, o.o_orderkey, l.l_partkey, l.l_quantity
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def flatten_two_level(spark: SparkSession, sf: str) -> DataFrame:
    """Customer -> orders[] -> items[]: two explode_outer steps and struct field access."""
    t = Tables(spark, sf)
    lines = nest(t.lineitem, ["l_orderkey"], ["l_partkey", "l_quantity"], "items")
    orders = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    # A customer may have any number of orders: its orders come in eight parts.
    per_cust = nest(orders, ["o_custkey"], ["o_orderkey", "items"], "orders", parts=8)
    body = t.customer.select("c_custkey").join(
        per_cust, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.struct(F.col("orders").alias("orders")).alias("body"))
    o = body.select("c_custkey", F.explode_outer("body.orders").alias("o"))
    i = o.select("c_custkey", F.col("o.o_orderkey").alias("o_orderkey"),
                 F.explode_outer("o.items").alias("i"))
    return i.select("c_custkey", "o_orderkey", F.col("i.l_partkey").alias("l_partkey"),
                    F.col("i.l_quantity").alias("l_quantity"))


@register("nest_orders", ops=("AGG12", "STR2", "STR3"), oracle="""
SELECT o_custkey,
  arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order_key,
  CAST(min(o_orderdate) AS DATE) AS first_order_date,
  CAST(count(*) AS INTEGER) AS n_orders,
  array_to_string(list_sort(list(o_orderkey)), ',') AS order_keys
FROM orders GROUP BY o_custkey
""")
def nest_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    s = o.groupBy("o_custkey").agg(
        F.min_by(F.struct("o_orderkey", "o_orderdate"),
                 F.struct("o_orderdate", "o_orderkey")).alias("first_order"),
        F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("orders"))
    return s.select("o_custkey", F.col("first_order.o_orderkey").alias("first_order_key"),
                    F.to_date("first_order.o_orderdate").alias("first_order_date"),
                    F.size("orders").alias("n_orders"),
                    F.array_join(F.transform("orders", lambda x: x["o_orderkey"].cast("string")), ",")
                    .alias("order_keys"))


# Rules for the payload classification over event props (first match wins).
PROPS_RULES = [('"k": 9', "transaction"), ('"k": 1', "engagement")]

CLASSIFY_ORACLE = """
SELECT event_id, user_id, event_type,
  CASE WHEN props IS NULL OR props = '' THEN 'no_data'
       WHEN contains(props, '"k": 9') THEN 'transaction'
       WHEN contains(props, '"k": 1') THEN 'engagement'
       ELSE 'other' END AS payload_class
FROM events
"""


@register("classify_payload_udf", ops=("UDF1",), oracle=CLASSIFY_ORACLE)
def classify_payload_udf_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    fn = classify_payload_udf(PROPS_RULES)
    return ev.select("event_id", "user_id", "event_type", fn("props").alias("payload_class"))


@register("classify_payload_native", ops=("UDF2", "PRJ8"), oracle=CLASSIFY_ORACLE)
def classify_payload_native_q(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    return ev.select("event_id", "user_id", "event_type",
                     classify_payload_native(F.col("props"), PROPS_RULES).alias("payload_class"))


SEGMENT_GROUPS = {"Industrial": ["MACHINERY", "BUILDING"], "Consumer": ["HOUSEHOLD", "FURNITURE"]}


@register("categorize_region", ops=("UDF3",), oracle="""
SELECT c_custkey, c_mktsegment,
  CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Industrial'
       WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Consumer'
       ELSE 'Other' END AS segment_group
FROM customer
""")
def categorize_region(spark: SparkSession, sf: str) -> DataFrame:
    c = Tables(spark, sf).customer
    fn = categorize_udf(SEGMENT_GROUPS, default="Other")
    return c.select("c_custkey", "c_mktsegment", fn("c_mktsegment").alias("segment_group"))


@register("url_parts", ops=("FUN2", "PRJ9", "PRJ8"), oracle=r"""
SELECT page_id,
  regexp_extract(url, '^(https?)://', 1) AS scheme,
  lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host,
  regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang,
  regexp_replace(url, '[?#].*$', '') AS clean_url,
  url LIKE '%?%' AS has_query,
  regexp_matches(url, '^https://') AS is_secure,
  CAST(length(url) AS INTEGER) AS url_length
FROM pages
""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Regex extraction and cleaning over whole URLs."""
    p = Tables(spark, sf).pages
    return p.select("page_id",
                    F.regexp_extract("url", r"^(https?)://", 1).alias("scheme"),
                    F.lower(F.regexp_extract("url", r"^https?://([^/?#]+)", 1)).alias("host"),
                    F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1).alias("lang"),
                    F.regexp_replace("url", r"[?#].*$", "").alias("clean_url"),
                    F.col("url").contains("?").alias("has_query"),
                    F.col("url").rlike(r"^https://").alias("is_secure"),
                    F.length("url").alias("url_length"))
