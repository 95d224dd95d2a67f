"""Counts taken while writing, progress tables, state read from checkpoints."""

import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidepool.operators.quality import Expectation, write_expected
from tidepool.session import scratch_path
from tidepool.streaming.monitor import ProgressLog, read_progress, state_operators, state_rows
from tidepool.streaming.runner import drain, drain_all

RULES = [Expectation("small", "v < 8"), Expectation("known", "v IS NOT NULL", "drop"), Expectation("even", "v % 2 = 0", "drop")]


def numbers(spark):
    return spark.range(1000, numPartitions=7).select("id", F.expr("CASE WHEN id % 10 = 3 THEN NULL ELSE id % 10 END").alias("v"))


def test_rows_and_counts_come_from_one_scan(spark):
    base = scratch_path(spark, "counts")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = numbers(spark).mapInPandas(count, "id long, v long")
    got = {r.rule: r for r in write_expected(df, f"{base}/rows", RULES, f"{base}/m", "a", "t").collect()}
    assert seen.value == 1000
    assert {k: r.failed for k, r in got.items()} == {"small": 300, "known": 100, "even": 500}
    assert {(r.total, r.written) for r in got.values()} == {(1000, 500)}
    assert spark.read.parquet(f"{base}/rows").count() == 500


def test_a_replayed_load_replaces_its_counts(spark):
    base = scratch_path(spark, "counts_again")
    for load in ("a", "b", "b"):
        write_expected(numbers(spark), f"{base}/rows/{load}", RULES, f"{base}/m", load, "t", "overwrite")
    assert spark.read.parquet(f"{base}/m").groupBy("load_id").count().filter("count = 3").count() == 2


def test_a_failing_row_rejects_the_batch(spark):
    base = scratch_path(spark, "counts_fail")
    with pytest.raises(PySparkException, match="expectation low failed"):
        write_expected(numbers(spark), f"{base}/rows", [*RULES, Expectation("low", "id < 900", "fail")], f"{base}/m", "a", "t")
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{base}/rows").count()
    with pytest.raises(PySparkException):
        spark.read.parquet(f"{base}/m").count()


@pytest.mark.parametrize("empty", ["filter", "local"])
def test_an_empty_batch_counts_zero(spark, empty):
    base = scratch_path(spark, "counts_empty")
    df = numbers(spark).filter("id < 0") if empty == "filter" else spark.createDataFrame([], "id long, v long")
    got = write_expected(df, f"{base}/rows", RULES, f"{base}/m", "a", "t").collect()
    assert [(r.failed, r.total, r.written) for r in got] == [(0, 0, 0)] * 3


def test_unknown_action_is_refused():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def landing(spark, base, files=5):
    spark.range(100).select("id", F.expr("timestamp_seconds(id * 60)").alias("ts")).repartition(files).write.parquet(f"{base}/in")
    return spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


def test_progress_of_two_queries_is_a_row_a_batch(spark):
    base = scratch_path(spark, "two_queries")
    s = landing(spark, base)
    with ProgressLog(spark, f"{base}/p", flush_every=2):
        drain_all({"a": (s, f"{base}/a", f"{base}/cka"), "b": (s.filter("id < 10"), f"{base}/b", f"{base}/ckb")})
    got = read_progress(spark, f"{base}/p")
    assert sorted((r.query_name, r.batch_id) for r in got.collect()) == [(q, b) for q in "ab" for b in range(5)]
    assert {r[0]: r[1] for r in got.groupBy("query_name").agg(F.sum("input_rows")).collect()} == {"a": 100, "b": 100}


def test_progress_can_be_read_while_the_query_runs(spark):
    base = scratch_path(spark, "running")
    s = landing(spark, base)
    with ProgressLog(spark, f"{base}/p", flush_every=1):
        q = s.writeStream.queryName("long").format("noop").option("checkpointLocation", f"{base}/ck") \
             .trigger(processingTime="100 milliseconds").start()
        q.processAllAvailable()
        rows, end = 0, time.time() + 30
        while rows < 100 and time.time() < end:
            try:
                rows = read_progress(spark, f"{base}/p").agg(F.sum("input_rows")).first()[0] or 0
            except PySparkException:  # nothing appended yet
                time.sleep(0.2)
        assert q.isActive and rows == 100
        q.stop()


def test_state_of_a_checkpoint(spark):
    base = scratch_path(spark, "state")
    s = landing(spark, base)
    drain(s.withWatermark("ts", "5 minutes").dropDuplicates(["id", "ts"]), f"{base}/out", f"{base}/ck")
    # The watermark ends at minute 94: keys of minutes 95 to 99 stay.
    assert sorted(r.key.id for r in state_rows(spark, f"{base}/ck").collect()) == [95, 96, 97, 98, 99]
    assert state_operators(spark, f"{base}/ck").first().operatorName == "dedupe"
