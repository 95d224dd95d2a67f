"""Running Structured Streaming queries to completion and reading their output.

``drain`` starts a query with an available-now trigger (process what is there,
then stop), a checkpoint in the shared scratch folder and a file sink, so a
rerun with the same checkpoint processes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Progress reports a drained query keeps: more than any drain here has micro-batches.
KEPT_REPORTS = 1_000_000


def drain(stream: DataFrame, sink_path: str | None, checkpoint: str, output_mode: str = "append",
          fmt: str = "parquet", foreach_batch: Callable[[DataFrame, int], None] | None = None,
          trigger: str = "availableNow", query_name: str | None = None, timeout_s: float | None = None,
          few_keys: bool = False):
    """Run ``stream`` until the available input is processed; returns the query handle.

    Waits as long as that takes. With ``timeout_s`` the query is stopped after
    so many seconds and TimeoutError raised: a drain never ends early in silence.
    The handle keeps the progress reports of all micro-batches. ``few_keys``: see ``_state_stores``.
    """
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", sink_path)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    elif trigger == "once":
        w = w.trigger(once=True)
    else:
        w = w.trigger(processingTime=trigger)
    with _all_reports(stream.sparkSession):
        with _state_stores(stream.sparkSession, few_keys):
            q = w.start()
        if trigger in ("availableNow", "once"):
            if timeout_s is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout_s):
                q.stop()
                raise TimeoutError(f"the stream was not drained within {timeout_s} s")
        else:
            # A processing-time trigger never ends by itself: process what is
            # there, then stop the query.
            q.processAllAvailable()
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def drain_all(streams: Mapping[str, tuple[DataFrame, str, str]], few_keys: bool | Collection[str] = False) -> dict:
    """Drain several streams at once, each (stream, sink folder, checkpoint) under its query name.

    ``few_keys``: see ``_state_stores``; for all streams, or for those named.
    """
    running = {}
    try:
        for name, (stream, sink, checkpoint) in streams.items():
            w = stream.writeStream.queryName(name).format("parquet").option("path", sink)
            with _state_stores(stream.sparkSession, few_keys if isinstance(few_keys, bool) else name in few_keys):
                running[name] = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        for q in running.values():
            q.awaitTermination()
    finally:
        for q in running.values():
            if q.isActive:
                q.stop()
    return running


def _all_reports(spark: SparkSession):
    """Queries keep more than the last 100 progress reports."""
    return _setting(spark, "spark.sql.streaming.numRecentProgressUpdates", str(KEPT_REPORTS))


def _state_stores(spark: SparkSession, few_keys: bool):
    """A stateful query started inside has a state store per shuffle partition; with ``few_keys`` no more than the cluster has cores.

    A store costs a task and files in every micro-batch, however few rows it holds: where the
    shuffle partitions follow the input and the state doesn't, most stores are empty.
    """
    return _setting(spark, "spark.sql.shuffle.partitions", str(few_stores(spark))) if few_keys else nullcontext()


def few_stores(spark: SparkSession) -> int:
    """State stores of a query of few keys."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """Queries started inside have this setting; the session gets its own back."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def to_event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session time zone is UTC."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """The query's recent progress reports as a DataFrame (one row per micro-batch)."""
    rows = [(p["batchId"], p.get("numInputRows", 0), p.get("inputRowsPerSecond") or 0.0,
             p.get("processedRowsPerSecond") or 0.0,
             sum(s.get("numRowsTotal", 0) for s in p.get("stateOperators", [])),
             p.get("eventTime", {}).get("watermark"))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, num_input_rows long, input_rows_per_second double, "
                                       "processed_rows_per_second double, state_rows long, watermark string")
