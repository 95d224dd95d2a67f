"""Structured Streaming (survey 2.14).

Events (plus retries: purchases sent again one minute later with the same id)
are landed as parquet files and read as a file stream; every query drains with
an available-now trigger into a parquet sink. Windowed aggregations run in
append mode: a window is emitted once the watermark (max event time seen minus
the delay) passes its end, so windows still open when the input ends are not
in the output - the oracles say the same with ``window_end <= max(ts) - delay``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import explode_struct_array, nest
from ..functions.numeric import rnd
from ..session import scratch_path
from ..sources import files as fs
from ..sources.tables import Tables
from ..streaming.monitor import ProgressLog, read_progress, state_rows
from ..streaming.runner import drain, drain_all, progress_frame, to_event_time
from .quality_checks import risk_score_df
from .registry import register

RETRIES_SQL = """src AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 MINUTE, user_id, event_type, value, props FROM events
  WHERE event_type = 'purchase')"""


def retried_events(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "purchase").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))


def events_with_retries(t: Tables) -> DataFrame:
    return t.events.unionByName(retried_events(t))


def event_stream(spark: SparkSession, sf: str, name: str, files: int = 4,
                 max_files_per_trigger: int | None = None) -> tuple[DataFrame, str]:
    """Land events + retries and open them as a stream with TIMESTAMP event time.

    ``max_files_per_trigger`` counts in ``files``: a larger input lands as more files, and a trigger
    takes as many times more, so the number of micro-batches stays.
    """
    base = scratch_path(spark, name)
    landed = events_with_retries(Tables(spark, sf))
    fs.write_files(landed, f"{base}/landing", "parquet", files)
    r = spark.readStream.schema(landed.schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", fs.files_a_trigger(spark, f"{base}/landing", math.ceil(files / max_files_per_trigger)))
    return to_event_time(r.parquet(f"{base}/landing"), "ts"), base


def _run(stream: DataFrame, base: str) -> DataFrame:
    drain(stream, f"{base}/out", f"{base}/_checkpoint")
    return stream.sparkSession.read.parquet(f"{base}/out")


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz")


@register("stream_dedup_watermark", ops=("STM1", "STM2"), oracle="""
SELECT event_id, user_id, event_type FROM events
""")
def stream_dedup_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Retries carry a new event time; deduplicate by id within a 5-minute watermark."""
    s, base = event_stream(spark, sf, "stream_dedup_wm")
    d = s.withWatermark("ts", "5 minutes").dropDuplicatesWithinWatermark(["event_id"])
    return _run(d.select("event_id", "user_id", "event_type"), base)


@register("stream_dedup_key", ops=("STM3",), oracle=f"""WITH {RETRIES_SQL}
SELECT DISTINCT event_id, ts FROM src
""")
def stream_dedup_key(spark: SparkSession, sf: str) -> DataFrame:
    """dropDuplicates on (id, event time) with a watermark: state for a key is
    dropped once the watermark passes its event time."""
    s, base = event_stream(spark, sf, "stream_dedup_key")
    d = s.withWatermark("ts", "10 minutes").dropDuplicates(["event_id", "ts"])
    return _run(d.select("event_id", _ntz("ts").alias("ts")), base)


def _bucket(seconds: int) -> str:
    return (f"TIMESTAMP '1970-01-01' + to_seconds(CAST(floor(epoch(ts) / {seconds}) * {seconds} AS BIGINT))")


@register("tumbling_velocity", ops=("STM4", "STM7"), oracle=f"""WITH {RETRIES_SQL},
w AS (SELECT user_id, {_bucket(600)} AS window_start, count(*) AS n_events, round(sum(value), 2) AS total_value
      FROM src GROUP BY 1, 2)
SELECT user_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end, n_events, total_value,
       n_events >= 3 AS is_spike
FROM w WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM src) - INTERVAL 10 MINUTE
""")
def tumbling_velocity(spark: SparkSession, sf: str) -> DataFrame:
    s, base = event_stream(spark, sf, "stream_tumbling")
    g = (s.withWatermark("ts", "10 minutes")
         .groupBy("user_id", F.window("ts", "10 minutes"))
         .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")))
    out = g.select("user_id", _ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                   "n_events", "total_value")
    res = _run(out, base)
    return res.withColumn("total_value", rnd("total_value", 2)).withColumn("is_spike", F.col("n_events") >= 3)


@register("sliding_amount", ops=("STM5",), oracle=f"""WITH {RETRIES_SQL},
k AS (SELECT * FROM range(12) t(k)),
x AS (SELECT s.*, {_bucket(300)} - k.k * INTERVAL 5 MINUTE AS window_start FROM src s CROSS JOIN k),
w AS (SELECT event_type, window_start, count(*) AS n_events, round(sum(value), 2) AS total_value
      FROM x GROUP BY 1, 2)
SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, n_events, total_value,
       total_value > 500 AS over_threshold
FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM src) - INTERVAL 10 MINUTE
""")
def sliding_amount(spark: SparkSession, sf: str) -> DataFrame:
    """1-hour windows sliding by 5 minutes, per event type, with a threshold flag."""
    s, base = event_stream(spark, sf, "stream_sliding")
    g = (s.withWatermark("ts", "10 minutes")
         .groupBy("event_type", F.window("ts", "1 hour", "5 minutes"))
         .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")))
    out = g.select("event_type", _ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                   "n_events", "total_value")
    res = _run(out, base)
    return res.withColumn("total_value", rnd("total_value", 2)) \
              .withColumn("over_threshold", F.col("total_value") > 500)


@register("session_window", ops=("STM6",), oracle=f"""WITH {RETRIES_SQL},
g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                       OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE
                     THEN 1 ELSE 0 END AS new_session FROM src),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
w AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events
      FROM s GROUP BY user_id, sid)
SELECT * FROM w WHERE session_end <= (SELECT max(ts) FROM src) - INTERVAL 30 MINUTE
""")
def session_window(spark: SparkSession, sf: str) -> DataFrame:
    """Session windows with a 30-minute gap (a gap of exactly 30 minutes stays in the session)."""
    s, base = event_stream(spark, sf, "stream_session")
    g = (s.withWatermark("ts", "30 minutes")
         .groupBy("user_id", F.session_window("ts", "30 minutes"))
         .agg(F.count(F.lit(1)).alias("n_events")))
    out = g.select("user_id", _ntz("session_window.start").alias("session_start"),
                   _ntz("session_window.end").alias("session_end"), "n_events")
    return _run(out, base)


@register("stream_alerts", ops=("STM9",), oracle=f"""WITH {RETRIES_SQL}
SELECT event_id, user_id, ts, value,
  CASE WHEN value > 40 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END
  + CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 THEN 25 ELSE 0 END
  + CASE WHEN hour(ts) < 6 THEN 15 ELSE 0 END AS risk_score
FROM src
WHERE CASE WHEN value > 40 THEN 30 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END
  + CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 THEN 25 ELSE 0 END
  + CASE WHEN hour(ts) < 6 THEN 15 ELSE 0 END > 70
""")
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Score every event in the stream and sink only the alerts."""
    s, base = event_stream(spark, sf, "stream_alerts")
    scored = risk_score_df(s).filter(F.col("is_alert")).drop("is_alert")
    return _run(scored.withColumn("ts", _ntz("ts")), base)


@register("stream_progress", ops=("STM13",))
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Per micro-batch progress (input rows, rates, state rows, watermark) as a DataFrame."""
    s, base = event_stream(spark, sf, "stream_progress", files=4, max_files_per_trigger=1)
    agg = s.withWatermark("ts", "10 minutes").groupBy("event_type", F.window("ts", "1 hour")).count()
    q = drain(agg, f"{base}/out", f"{base}/_checkpoint", few_keys=True)
    return progress_frame(spark, q)


@register("stream_complete_counts", ops=("SNK12", "STM11"), oracle=f"""WITH {RETRIES_SQL}
SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value FROM src GROUP BY 1
""")
def stream_complete_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Complete output mode: every micro-batch rewrites the full result table
    (foreachBatch overwrite, since file sinks only append)."""
    s, base = event_stream(spark, sf, "stream_complete", files=4, max_files_per_trigger=2)
    out = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"))

    def overwrite(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    drain(out, None, f"{base}/_checkpoint", output_mode="complete", foreach_batch=overwrite, few_keys=True)
    return spark.read.parquet(f"{base}/out").withColumn("total_value", rnd("total_value", 2))


@register("stream_static_inner", ops=("JOI11",), oracle=f"""WITH {RETRIES_SQL}
SELECT s.event_id, s.ts, c.c_custkey, c.c_mktsegment FROM src s JOIN customer c ON s.user_id = c.c_custkey
""")
def stream_static_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Stream-static inner join: events of unknown users are dropped."""
    s, base = event_stream(spark, sf, "stream_inner")
    dim = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    joined = s.join(dim, F.col("user_id") == F.col("c_custkey")).select("event_id", _ntz("ts").alias("ts"), "c_custkey", "c_mktsegment")
    return _run(joined, base)


def line_stream(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, str]:
    """Lineitem landed as files and opened as a stream."""
    lines = Tables(spark, sf).lineitem
    base = scratch_path(spark, name)
    fs.write_files(lines, f"{base}/landing", "parquet", 2)
    return spark.readStream.schema(lines.schema).parquet(f"{base}/landing"), base


@register("stream_split", ops=("STM8",), oracle="""
SELECT CASE WHEN l_returnflag = 'R' THEN 'returns' ELSE 'sales' END AS sink,
       l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 2) AS net
FROM lineitem
""")
def stream_split(spark: SparkSession, sf: str) -> DataFrame:
    """One stream filtered into two sinks, sales and returns, each with its own checkpoint; a NULL flag is a sale."""
    lines, base = line_stream(spark, sf, "stream_split")
    net = rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net")
    returned = F.coalesce(F.col("l_returnflag") == "R", F.lit(False))
    out = None
    for sink, rows in (("sales", lines.filter(~returned)), ("returns", lines.filter(returned))):
        drain(rows.select("l_orderkey", "l_linenumber", net), f"{base}/{sink}", f"{base}/_checkpoint_{sink}")
        part = spark.read.parquet(f"{base}/{sink}").withColumn("sink", F.lit(sink))
        out = part if out is None else out.unionByName(part)
    return out


@register("stream_explode_lines", ops=("STM10",), oracle="""
SELECT o.o_orderkey, o.o_custkey, l.l_partkey, l.l_quantity
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def stream_explode_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with nested lines arrive as a stream; each line becomes a row."""
    t = Tables(spark, sf)
    lines = nest(t.lineitem, ["l_orderkey"], ["l_partkey", "l_quantity"], "line_items")
    orders = (t.orders.select("o_orderkey", "o_custkey")
              .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey"))
    base = scratch_path(spark, "stream_explode")
    orders.write.parquet(f"{base}/landing")
    stream = spark.readStream.schema(orders.schema).parquet(f"{base}/landing")
    return _run(explode_struct_array(stream, "line_items"), base)


@register("stream_monitor", ops=("STM13",), oracle=f"""WITH {RETRIES_SQL}
SELECT 'hourly_counts' AS query_name, count(*) AS input_rows, true AS row_a_batch, true AS knows_state FROM src
UNION ALL SELECT 'purchases', count(*), true, false FROM src
""")
def stream_monitor(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams run at once while a listener appends their progress to a table."""
    s, base = event_stream(spark, sf, "stream_monitor", files=4, max_files_per_trigger=1)
    hourly = s.withWatermark("ts", "10 minutes").groupBy("event_type", F.window("ts", "1 hour")).count()
    with ProgressLog(spark, f"{base}/progress", flush_every=3):
        drain_all({"purchases": (s.filter("event_type = 'purchase'"), f"{base}/purchases", f"{base}/_ck_purchases"),
                   "hourly_counts": (hourly, f"{base}/hourly", f"{base}/_ck_hourly")}, few_keys=True)
    got = read_progress(spark, f"{base}/progress").filter(F.col("query_name").isin("purchases", "hourly_counts"))
    return got.groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"),
        ((F.count(F.lit(1)) == F.countDistinct("batch_id")) & (F.count(F.lit(1)) == F.max("batch_id") + 1)).alias("row_a_batch"),
        (F.max("state_rows") > 0).alias("knows_state"))


RESTART_AT, LATE_BEFORE, LATE_ID = "2024-01-21", "2024-01-06", 1_000_000_000


@register("stream_state_after_restart", ops=("STM3", "STM7", "STM12"), oracle=f"""WITH {RETRIES_SQL},
w AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS last_mark,
        date_trunc('millisecond', max(ts) FILTER (WHERE ts < TIMESTAMP '{RESTART_AT}')) - INTERVAL 10 MINUTE AS first_mark FROM src)
SELECT (SELECT count(DISTINCT (event_id, ts)) FROM src) AS rows_out,
  (SELECT count(DISTINCT (event_id, ts)) FROM src, w WHERE ts > last_mark) AS keys_in_state,
  (SELECT count(*) FROM src, w WHERE ts < TIMESTAMP '{LATE_BEFORE}' AND ts <= first_mark) AS rows_dropped,
  true AS state_reported
""")
def stream_state_after_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplication stopped and started again, the second time over rows behind the watermark too:
    rows it dropped, and the keys that its checkpoint still holds."""
    rows = events_with_retries(Tables(spark, sf))
    base = scratch_path(spark, "stream_state")
    late = rows.filter(F.col("ts") < LATE_BEFORE).withColumn("event_id", F.col("event_id") + LATE_ID)
    loads = [rows.filter(F.col("ts") < RESTART_AT), rows.filter(F.col("ts") >= RESTART_AT).unionByName(late)]
    with ProgressLog(spark, f"{base}/progress"):
        for load in loads:
            load.write.mode("append").parquet(f"{base}/landing")
            stream = to_event_time(spark.readStream.schema(rows.schema).parquet(f"{base}/landing"), "ts")
            deduped = stream.withWatermark("ts", "10 minutes").dropDuplicates(["event_id", "ts"])
            drain(deduped.select("event_id", "ts"), f"{base}/out", f"{base}/_checkpoint", query_name="restarted_dedup")
    progress = read_progress(spark, f"{base}/progress").filter("query_name = 'restarted_dedup'")
    kept = state_rows(spark, f"{base}/_checkpoint").agg(F.count(F.lit(1)).alias("keys_in_state"))
    out = spark.read.parquet(f"{base}/out").agg(F.count(F.lit(1)).alias("rows_out"))
    seen = progress.agg(F.sum("dropped_by_watermark").alias("rows_dropped"), F.max_by("state_rows", "batch_id").alias("_last"))
    one = F.lit(1).alias("_one")
    return (out.select(one, "*").join(kept.select(one, "*"), "_one").join(seen.select(one, "*"), "_one")
            .select("rows_out", "keys_in_state", "rows_dropped", (F.col("_last") == F.col("keys_in_state")).alias("state_reported")))
