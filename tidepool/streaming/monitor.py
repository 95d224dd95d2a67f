"""Watching streams while they run: progress kept in a table, state read from checkpoints."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("query_name string, query_id string, run_id string, batch_id long, reported_at string, input_rows long, "
            "input_rows_per_second double, processed_rows_per_second double, batch_ms long, state_rows long, "
            "dropped_by_watermark long, watermark string")


class ProgressLog(StreamingQueryListener):
    """Appends the progress reports of all queries of a session to a Parquet folder.

    Reports are appended ``flush_every`` at a time and whenever a query ends, so the
    driver holds no more than that and a reader sees running queries. Reports
    not yet appended are lost with the driver. Use it as a context manager: leaving it
    waits up to ``wait_s`` seconds for the ends of queries that were started inside.

    A report is made per micro-batch; idle triggers of a processing-time query
    report their last batch again, with no input rows.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 100, wait_s: float = 60):
        self._spark, self._path = spark, path
        self._flush_every, self._wait_s = flush_every, wait_s
        self._rows: list[tuple] = []
        self._running: set[str] = set()
        self._changed = threading.Condition(threading.RLock())

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        with self._changed:
            ended = self._changed.wait_for(lambda: not self._running, self._wait_s)
        self._spark.streams.removeListener(self)
        self._flush()
        if not ended and exc[0] is None:
            raise TimeoutError("queries were still running when their progress log was closed")

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        row = (p.name, str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, float(p.inputRowsPerSecond),
               float(p.processedRowsPerSecond), p.batchDuration, sum(s.numRowsTotal for s in state),
               sum(s.numRowsDroppedByWatermark for s in state), p.eventTime.get("watermark"))
        with self._changed:
            self._rows.append(row)
            full = len(self._rows) >= self._flush_every
        if full:
            self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._flush()
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def _flush(self) -> None:
        with self._changed:
            rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self._path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The reports appended so far (none: no rows)."""
    return spark.read.schema(PROGRESS).parquet(path)


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int = 0, batch_id: int | None = None) -> DataFrame:
    """Rows that a stateful operator keeps, ``key`` and ``value`` as structs, after its last or a given batch."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        r = r.option("batchId", batch_id)
    return r.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """A row per stateful operator and store of a checkpoint: its name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")
