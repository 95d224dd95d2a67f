"""Layout jobs and layout reports (survey 2.13)."""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import footers as ft
from ..operators import layout as lay
from ..operators.statistics import CostBased, join_order
from ..session import scratch_path
from ..sources.sinks import write_partitioned
from ..sources.tables import Tables
from .registry import register

# Small target so the test-scale tables still produce several files.
TEST_TARGET_FILE_BYTES = 256 * 1024
#: Lineitem's bytes for each file of the layouts that reports compare; a sort holds some ten times as much.
LAYOUT_FILE_BYTES = 32 * 1024 * 1024
#: Lineitem's bytes for each file of the small-file fixture: an eighth of what its compaction aims at, as rows dealt out by a hash take more bytes.
SMALL_FILE_BYTES = 512 * 1024
APPENDS = 7


def fragmented_lineitem(spark: SparkSession, sf: str, path: str) -> str:
    """Small-file fixture: every row lands once, in seven appends dealt out by a hash of the row. A larger table lands in more files, not in larger ones."""
    li = Tables(spark, sf).lineitem
    part = F.pmod(F.xxhash64(*li.columns), F.lit(APPENDS))
    files = max(4, li.rdd.getNumPartitions(), math.ceil(line_files(spark, sf, 1, SMALL_FILE_BYTES) / APPENDS))
    for n in range(APPENDS):
        li.filter(part == n).repartition(files).write.mode("append").parquet(path)
    return path


@register("compact_files", ops=("LAY2", "LAY12", "SNK11"), oracle="SELECT * FROM lineitem")
def compact_files(spark: SparkSession, sf: str) -> DataFrame:
    """Compaction keeps every row and leaves fewer files."""
    base = scratch_path(spark, "compact")
    fragmented_lineitem(spark, sf, f"{base}/raw")
    lay.compact(spark, f"{base}/raw", f"{base}/compacted", target_file_bytes=4 * 1024 * 1024)
    before = lay.file_report(spark, f"{base}/raw").first()["num_files"]
    after = lay.file_report(spark, f"{base}/compacted").first()["num_files"]
    if not after < before:
        raise AssertionError(f"compaction did not reduce files: {before} -> {after}")
    return spark.read.parquet(f"{base}/compacted")


@register("file_report", ops=("LAY7", "LAY8"))
def file_report(spark: SparkSession, sf: str) -> DataFrame:
    """Before/after report of a compaction (files, bytes, average size)."""
    base = scratch_path(spark, "file_report")
    fragmented_lineitem(spark, sf, f"{base}/raw")
    lay.compact(spark, f"{base}/raw", f"{base}/compacted", target_file_bytes=4 * 1024 * 1024)
    b = lay.file_report(spark, f"{base}/raw").select(F.lit("before").alias("stage"), "*")
    a = lay.file_report(spark, f"{base}/compacted").select(F.lit("after").alias("stage"), "*")
    return b.unionByName(a)


@register("zorder_layout", ops=("LAY3",), oracle="SELECT * FROM lineitem")
def zorder_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Z-order lineitem on (part, supplier); the rewrite keeps the multiset of rows."""
    li = Tables(spark, sf).lineitem
    base = scratch_path(spark, "zorder")
    li.write.parquet(f"{base}/raw")
    n = lay.files_for_target(spark, f"{base}/raw", TEST_TARGET_FILE_BYTES)
    lay.zorder(spark.read.parquet(f"{base}/raw"), ["l_partkey", "l_suppkey"], f"{base}/z", num_files=max(n, 4))
    return spark.read.parquet(f"{base}/z")


@register("cluster_layout", ops=("LAY4", "LAY5", "LAY6"), oracle="SELECT * FROM orders")
def cluster_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Move a status-partitioned orders folder to one clustered by (customer, date)."""
    o = Tables(spark, sf).orders
    base = scratch_path(spark, "cluster")
    write_partitioned(o, f"{base}/partitioned", ["o_orderstatus"])
    spec = lay.LayoutSpec(cluster_by=["o_custkey", "o_orderdate"])
    spec.save(spark, f"{base}/clustered")
    src = spark.read.parquet(f"{base}/partitioned").select(*o.columns)
    lay.apply_clustering(src, lay.LayoutSpec.load(spark, f"{base}/clustered"), f"{base}/clustered/data", 4)
    out = spark.read.parquet(f"{base}/clustered/data")
    return out.select(*o.columns)


def line_files(spark: SparkSession, sf: str, at_least: int, file_bytes: int | None = None) -> int:
    """Files of a layout of lineitem: more for a larger table, as a task sorts what goes to one file."""
    return max(at_least, lay.files_for_target(spark, f"{sf.rstrip('/')}/lineitem.parquet", file_bytes or LAYOUT_FILE_BYTES))


@register("skipping_report", ops=("LAY10"))
def skipping_report(spark: SparkSession, sf: str) -> DataFrame:
    """Files a point filter on (part, supplier) must read: raw layout vs z-ordered."""
    li = Tables(spark, sf).lineitem
    base = scratch_path(spark, "skipping")
    n = line_files(spark, sf, 8)
    lay.deal(li, f"{base}/raw", n, LAYOUT_FILE_BYTES)
    lay.zorder(spark.read.parquet(f"{base}/raw"), ["l_partkey", "l_suppkey"], f"{base}/z", num_files=n)
    probe_row = li.select("l_partkey", "l_suppkey").orderBy("l_partkey", "l_suppkey").first()
    probe = {"l_partkey": probe_row[0], "l_suppkey": probe_row[1]}
    raw = lay.skipping_report(spark, f"{base}/raw", probe).select(F.lit("raw").alias("layout"), "*")
    z = lay.skipping_report(spark, f"{base}/z", probe).select(F.lit("zorder").alias("layout"), "*")
    return raw.unionByName(z)


@register("orphan_files", ops=("LAY9",))
def orphan_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a replaced version are orphans once older than the retention window."""
    o = Tables(spark, sf).orders
    base = scratch_path(spark, "orphans")
    o.repartition(3).write.parquet(f"{base}/data/v1")
    o.repartition(2).write.parquet(f"{base}/data/v2")
    live = lay.list_files(spark, f"{base}/data/v2").select("path")
    eight_days_later = int(time.time() * 1000) + 8 * 24 * 3600 * 1000
    return lay.orphan_files(spark, f"{base}/data", live, now_ms=eight_days_later)


@register("footer_skipping", ops=("LAY7", "LAY8", "LAY10"), oracle="""WITH p AS (
  SELECT l_partkey, l_suppkey FROM lineitem ORDER BY l_partkey, l_suppkey LIMIT 1),
one AS (SELECT count(*) AS total_rows, count(*) - count(l_partkey) AS null_parts,
          CAST(min(l_partkey) AS VARCHAR) AS first_part, CAST(max(l_partkey) AS VARCHAR) AS last_part,
          count(*) FILTER (WHERE (l_partkey, l_suppkey) = (SELECT (l_partkey, l_suppkey) FROM p)) AS rows_found
        FROM lineitem)
SELECT layout, one.*, true AS groups_hold_all, layout = 'zorder' AS reads_fewer
FROM one, (VALUES ('raw'), ('partitioned'), ('zorder')) t(layout)
""")
def footer_skipping(spark: SparkSession, sf: str) -> DataFrame:
    """What a point filter must read, from footers alone, for three layouts; the files named may hold every row found."""
    li = Tables(spark, sf).lineitem
    base = scratch_path(spark, "footers")
    n = line_files(spark, sf, 8)
    lay.deal(li, f"{base}/raw", n, LAYOUT_FILE_BYTES)
    write_partitioned(li, f"{base}/partitioned", ["l_returnflag"])
    lay.zorder(spark.read.parquet(f"{base}/raw"), ["l_partkey", "l_suppkey"], f"{base}/zorder", num_files=n)
    first = li.select("l_partkey", "l_suppkey").orderBy("l_partkey", "l_suppkey").first()
    probe = first.asDict()
    out = None
    for layout in ("raw", "partitioned", "zorder"):
        path = f"{base}/{layout}"
        tag = F.lit(layout).alias("layout")
        parts = ft.footer_stats(spark, path, ["l_partkey"], probe)
        ranges = parts.agg(F.sum("nulls").alias("null_parts"), F.min(F.col("min").cast("long")).cast("string").alias("first_part"),
                           F.max(F.col("max").cast("long")).cast("string").alias("last_part")).select(tag, "*")
        wanted = (F.col("l_partkey") == probe["l_partkey"]) & (F.col("l_suppkey") == probe["l_suppkey"])
        found = spark.read.parquet(path).filter(wanted).agg(F.count(F.lit(1)).alias("rows_found")).select(tag, "*")
        report = ft.footer_report(spark, path, probe).select(tag, "*")
        row = report.join(ranges, "layout").join(found, "layout").select(
            "layout", "total_rows", "null_parts", "first_part", "last_part", "rows_found",
            (F.col("rows_found") <= F.col("rows_to_read")).alias("groups_hold_all"),
            (F.col("groups_to_read") * 2 <= F.col("total_groups")).alias("reads_fewer"))
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ statistics that change a plan

ANALYZED = {"part": ["p_partkey", "p_size", "p_name"], "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
            "customer": ["c_custkey", "c_nationkey", "c_mktsegment"], "lineitem": ["l_orderkey", "l_partkey", "l_quantity"]}
TEXTS = ("p_name", "c_mktsegment")
FILTERED = {"part": ["p_size"], "orders": ["o_totalprice"], "customer": ["c_nationkey"], "lineitem": ["l_quantity"]}
#: The optimizer's distinct counts have a relative standard error of 5 %; four of them are allowed.
DISTINCT_ERROR = 0.2


def _cost_based(spark: SparkSession, sf: str) -> CostBased:
    return CostBased(spark, {t: f"{sf.rstrip('/')}/{t}.parquet" for t in ANALYZED})


def _statistics_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls,
  {"CAST(NULL AS DOUBLE)" if c in TEXTS else f"CAST(min({c}) AS DOUBLE)"} AS least,
  {"CAST(NULL AS DOUBLE)" if c in TEXTS else f"CAST(max({c}) AS DOUBLE)"} AS greatest,
  count(DISTINCT {c}) AS distinct_exact, true AS estimate_in_bound, {str(c in FILTERED[t]).lower()} AS has_histogram FROM {t}"""
        for t, columns in ANALYZED.items() for c in columns)


@register("column_statistics", ops=("LAY11",), oracle=_statistics_sql())
def column_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """What ANALYZE tells the optimizer about the columns of four tables, next to exact distinct counts."""
    t, out = Tables(spark, sf), None
    with _cost_based(spark, sf) as cost:
        for name, columns in ANALYZED.items():
            cost.analyze(name, columns, FILTERED[name])
            stats = cost.statistics(name, columns)
            exact = getattr(t, name).agg(*[F.count_distinct(c).alias(c) for c in columns])
            exact = exact.unpivot([], columns, "column", "distinct_exact")
            off = F.abs(F.col("distinct_estimate") - F.col("distinct_exact")) <= DISTINCT_ERROR * F.col("distinct_exact")
            row = stats.join(exact, "column").select(
                "table_name", "column", "rows", "nulls", F.col("min").cast("double").alias("least"), F.col("max").cast("double").alias("greatest"),
                "distinct_exact", off.alias("estimate_in_bound"), F.col("bins").isNotNull().alias("has_histogram"))
            out = row if out is None else out.unionByName(row)
    return out


SMALL_PARTS = "p_size <= 2"


def sales_of_small_parts(table) -> DataFrame:
    """Four tables joined in the order of the star's keys; the filter that leaves 1 line in 25 stands on the last one."""
    lines, orders, customers, parts = table("lineitem"), table("orders"), table("customer"), table("part").filter(SMALL_PARTS)
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("p_size", "c_mktsegment").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("units")))


@register("cost_based_join", ops=("LAY11",), oracle=f"""
SELECT p_size, c_mktsegment, count(*) AS n_lines, sum(l_quantity) AS units, true AS parts_before_orders
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
WHERE {SMALL_PARTS} GROUP BY p_size, c_mktsegment
""")
def cost_based_join(spark: SparkSession, sf: str) -> DataFrame:
    """With statistics the few small parts are joined before orders and customers; as written they come last."""
    with _cost_based(spark, sf) as cost:
        for name, columns in ANALYZED.items():
            cost.analyze(name, columns, FILTERED[name])
        sales = sales_of_small_parts(cost.table)
        read = [path.rsplit("/", 1)[-1] for path in join_order(sales)]
    return sales.withColumn("parts_before_orders", F.lit(read.index("part.parquet") < read.index("orders.parquet")))
