"""Inputs of many splits: micro-batches stay as many, keys are dealt over tasks only if one of them is large."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidepool.plans import registry_dicts
from tidepool.session import scratch_path
from tidepool.streaming import cdc
from tidepool.streaming.monitor import state_operators

SPLITS = 9


def run(name, spark, sf):
    return registry_dicts()[0][name](spark, sf)


def input_batches(query):
    return len([p for p in query.recentProgress if p["numInputRows"] > 0])


@pytest.fixture
def many_splits(spark, monkeypatch):
    """A table folder whose events and orders are read in nine splits each."""
    key, sf = "spark.sql.files.openCostInBytes", scratch_path(spark, "many_splits")
    old = spark.conf.get(key)
    start = F.lit(dt.datetime(1998, 6, 1)).cast("timestamp_ntz")
    i = F.col("id")
    spark.range(360).select(
        i.alias("event_id"), (start + F.make_dt_interval(F.lit(0), (i * 7) % 360)).alias("ts"), (i % 20).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "click", "purchase"))), (i % 3 + 1).cast("int")).alias("event_type"),
        (i % 60).cast("double").alias("value"), F.lit("{}").alias("props")).repartition(SPLITS).write.parquet(f"{sf}/events.parquet")
    spark.range(360).select(
        i.alias("o_orderkey"), (i % 20).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), i.cast("double").alias("o_totalprice"),
        (start + F.make_dt_interval(i * 3)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    ).repartition(SPLITS).write.parquet(f"{sf}/orders.parquet")
    spark.conf.set(key, str(256 << 20))
    yield sf
    spark.conf.set(key, old)


def captured(monkeypatch, module, name):
    """The results of a function of a module, as it goes on being called."""
    got, fn = [], getattr(module, name)

    def call(*args, **kw):
        got.append(fn(*args, **kw))
        return got[-1]

    monkeypatch.setattr(module, name, call)
    return got


def test_auto_cdc_stream_has_four_batches(spark, many_splits, monkeypatch):
    drained = captured(monkeypatch, cdc, "drain")
    got = run("auto_cdc_stream", spark, many_splits).collect()
    assert [input_batches(q) for q in drained] == [4]
    assert sorted(map(repr, got)) == sorted(map(repr, run("auto_cdc_scd2", spark, many_splits).collect()))


def test_only_a_large_key_is_dealt_over_tasks(spark, monkeypatch):
    path = scratch_path(spark, "hot")
    spark.range(20000).select((F.col("id") % 500).alias("many"), F.when(F.col("id") % 10 > 0, F.lit(1)).alias("one"), "id").write.parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr(cdc, "ONE_TASK_BYTES", cdc.estimated_bytes(df) // 4)
    assert not cdc.has_hot_key(df, ["many"])
    assert cdc.has_hot_key(df, ["one"])
    assert cdc.has_hot_key(df.filter("one IS NULL OR id < 5"), ["one"])  # NULL is a key
    monkeypatch.setattr(cdc, "ONE_TASK_BYTES", cdc.estimated_bytes(df))
    assert not cdc.has_hot_key(df, ["one"])


def test_stream_merge_upsert_has_three_batches(spark, many_splits, monkeypatch):
    from tidepool.plans import ingest
    drained = captured(monkeypatch, ingest, "drain")
    got = run("stream_merge_upsert", spark, many_splits)
    assert [input_batches(q) for q in drained] == [3]
    late = got.filter("o_orderdate >= '1999-01-01'").count()
    assert 0 < late < got.count() == got.select("o_orderkey").distinct().count() == 360
    assert got.filter("o_orderstatus = 'O'").count() == late  # each late order was updated once


def test_stream_progress_has_four_batches(spark, many_splits):
    got = run("stream_progress", spark, many_splits).filter("num_input_rows > 0")
    assert got.count() == 4 and got.agg(F.sum("num_input_rows")).first()[0] == 480


def test_stream_monitor_has_four_batches_a_query(spark, many_splits, monkeypatch):
    from tidepool.plans import streams
    drained = captured(monkeypatch, streams, "drain_all")
    got = {r.query_name: r for r in run("stream_monitor", spark, many_splits).collect()}
    assert {n: input_batches(q) for n, q in drained[0].items()} == {"purchases": 4, "hourly_counts": 4}
    assert {n: r.input_rows for n, r in got.items()} == {"purchases": 480, "hourly_counts": 480} and all(r.row_a_batch for r in got.values())


@contextmanager
def shuffle_partitions(spark, n):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
        assert spark.conf.get(key) == str(n)
    finally:
        spark.conf.set(key, old)


def stores(spark, paths, checkpoint):
    """Numbers of state stores in the checkpoints of that name under the scratch folders."""
    return [r.numPartitions for p in paths for r in state_operators(spark, f"{p}/{checkpoint}").collect()]


@pytest.mark.parametrize("name,checkpoint", [("stream_monitor", "_ck_hourly"), ("stream_progress", "_checkpoint"), ("stream_complete_counts", "_checkpoint")])
def test_few_keys_have_no_more_state_stores_than_cores(spark, many_splits, monkeypatch, name, checkpoint):
    from tidepool.plans import streams
    paths, cores = captured(monkeypatch, streams, "scratch_path"), spark.sparkContext.defaultParallelism
    with shuffle_partitions(spark, cores + 5):
        got = run(name, spark, many_splits)
        assert stores(spark, paths, checkpoint) == [cores]
        if name == "stream_monitor":
            rows = {r.query_name: (r.input_rows, r.row_a_batch, r.knows_state) for r in got.collect()}
            assert rows == {"purchases": (480, True, False), "hourly_counts": (480, True, True)}
        elif name == "stream_complete_counts":
            assert {r.event_type: r.n_events for r in got.collect()} == {"view": 120, "click": 120, "purchase": 240}


def test_other_state_keeps_a_store_a_shuffle_partition(spark, many_splits, monkeypatch):
    from tidepool.plans import streams
    paths, cores = captured(monkeypatch, streams, "scratch_path"), spark.sparkContext.defaultParallelism
    with shuffle_partitions(spark, cores + 5):
        run("stream_dedup_key", spark, many_splits)
        assert stores(spark, paths, "_checkpoint") == [cores + 5]


def lines(spark):
    i = F.col("id")
    return spark.range(720).select(
        (i % 360).alias("l_orderkey"), (i % 30).alias("l_partkey"), (i % 7).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (i % 50).cast("double").alias("l_quantity"), (i + 1).cast("double").alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.when(i % 4 == 0, "R").when(i % 4 == 1, "N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("l_shipdate"))


def test_layouts_of_a_larger_table_have_more_files(spark, monkeypatch):
    """What a task sorts is a file's rows: they stay few, with no row lost and the session's settings as they were."""
    from tidepool.operators import layout as lay
    from tidepool.plans import layouts
    sf = scratch_path(spark, "large_lines")
    lines(spark).repartition(2).write.parquet(f"{sf}/lineitem.parquet")
    size = lay.file_report(spark, f"{sf}/lineitem.parquet").first()["total_bytes"]
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    assert {r.total_files for r in run("skipping_report", spark, sf).collect()} == {8}
    monkeypatch.setattr(layouts, "LAYOUT_FILE_BYTES", size // 20 + 1)
    got = run("skipping_report", spark, sf).collect()
    assert all(r.total_files > 15 and r.total_rows == 720 and r.probe_rows == 4 for r in got), got
    assert spark.conf.get(key) == old


def test_small_files_of_a_larger_table_stay_small(spark, monkeypatch):
    """Compaction finds more small files in a larger table, not files that are as large as those it writes."""
    from tidepool.operators import layout as lay
    from tidepool.plans import layouts
    sf = scratch_path(spark, "fragments")
    rows = spark.range(40000).select(F.xxhash64("id").alias("l_orderkey"), F.xxhash64("id", F.lit(1)).alias("l_partkey"), F.hash("id").alias("l_linenumber"))
    rows.repartition(2).write.parquet(f"{sf}/lineitem.parquet")
    size = lay.file_report(spark, f"{sf}/lineitem.parquet").first()["total_bytes"]
    compact, key = lay.compact, "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    # The sizes of a table so large that each of 28 files would have the compaction's target.
    raw = scratch_path(spark, "raw")
    target = lay.file_report(spark, layouts.fragmented_lineitem(spark, sf, raw)).first()["total_bytes"] // 28
    monkeypatch.setattr(layouts, "SMALL_FILE_BYTES", size // 200, raising=False)
    monkeypatch.setattr(lay, "compact", lambda spark, src, dst, target_file_bytes: compact(spark, src, dst, target))
    got = run("compact_files", spark, sf)
    assert got.count() == 40000 and got.exceptAll(rows).isEmpty()
    report = {r.stage: r.num_files for r in run("file_report", spark, sf).collect()}
    assert report["before"] > 28 and report["after"] < report["before"]
    assert spark.conf.get(key) == old


def test_pipeline_retail_has_two_batches(spark, many_splits, monkeypatch):
    from tidepool.plans import pipelines
    drained, landed = captured(monkeypatch, pipelines, "drain"), captured(monkeypatch, pipelines.fs, "write_files")
    n = F.col("id")
    lines(spark).repartition(SPLITS).write.parquet(f"{many_splits}/lineitem.parquet")
    spark.range(30).select(n.alias("p_partkey"), F.lit("p").alias("p_name"), F.lit("t").alias("p_type")).write.parquet(f"{many_splits}/part.parquet")
    spark.range(7).select(n.alias("s_suppkey"), F.lit("s").alias("s_name")).write.parquet(f"{many_splits}/supplier.parquet")
    spark.range(20).select(n.alias("c_custkey"), F.lit("c").alias("c_name"), F.lit("m").alias("c_mktsegment")).write.parquet(f"{many_splits}/customer.parquet")
    got = run("pipeline_retail", spark, many_splits).agg(F.sum("units"), F.sum("n_lines")).first()
    assert [input_batches(q) for q in drained] == [2]
    sold = [i for i in range(720) if i % 4 and i % 50]
    assert tuple(got) == (sum(i % 50 for i in sold), len(sold))
    # The landing is the input's splits as they lay, not dealt anew.
    rows = spark.read.parquet(landed[0]).groupBy(F.input_file_name()).count()
    assert rows.count() == SPLITS


def test_window_state_of_payments_follows_the_open_windows(spark, many_splits, monkeypatch):
    """Streams of windows read slices of event time: the same marts, a part of the state, no row behind the watermark."""
    from tidepool.plans import marts
    from tidepool.streaming import replay
    i = F.col("id")
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    spark.range(600).select(
        i.alias("event_id"), F.when(i % 50 > 0, start + F.make_dt_interval(F.lit(0), F.lit(0), i * 2)).alias("ts"), (i % 20).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("view", "purchase", "error"))), (i % 3 + 1).cast("int")).alias("event_type"),
        (i % 60).cast("double").alias("value"), F.lit('{"k": 90}').alias("props")).repartition(SPLITS).write.parquet(f"{many_splits}/payments/events.parquet")
    spark.range(20).select(i.alias("c_custkey"), F.lit("m").alias("c_mktsegment")).write.parquet(f"{many_splits}/payments/customer.parquet")
    drained, silver = captured(monkeypatch, marts, "drain_all"), captured(monkeypatch, marts, "payments_silver")
    got = []
    for rows_a_store in (replay.ROWS_A_STORE, 100):
        monkeypatch.setattr(replay, "ROWS_A_STORE", rows_a_store)
        got.append(sorted(map(repr, run("payments_marts", spark, f"{many_splits}/payments").collect())))
    assert got[0] == got[1] and any("prefill" in r and "n_hours_over_limit=0" not in r for r in got[0])
    at_once, sliced = (q["hourly"] for q in drained)
    most = [max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) for q in (at_once, sliced)]
    assert input_batches(at_once) == 1 and input_batches(sliced) > 5 and most[1] < most[0] / 2
    hourly = [sorted(map(tuple, spark.read.parquet(f"{path}/hourly").collect()), key=repr) for path in silver]
    assert hourly[0] == hourly[1] and len(hourly[0]) > 1000
    assert sum(o["numRowsDroppedByWatermark"] for q in drained[1].values() for p in q.recentProgress for o in p["stateOperators"]) == 0


def test_slices_land_in_event_time_order(spark):
    from tidepool.streaming.replay import land_by_time
    path = scratch_path(spark, "slices")
    i = F.col("id")
    rows = spark.range(1000).select(F.when(i % 100 > 0, (i * 7919 % 1000).cast("timestamp")).alias("ts"), (i % 7).alias("k")).repartition(4)
    assert land_by_time(rows, "ts", path, 5)
    landed = spark.read.parquet(f"{path}/landing")
    assert landed.exceptAll(rows).isEmpty() and rows.exceptAll(landed).isEmpty()
    files = landed.groupBy(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path")).agg(F.min("ts"), F.max("ts")).orderBy("at").collect()
    assert len(files) == 5 and all(a["max(ts)"] < b["min(ts)"] for a, b in zip(files, files[1:], strict=False))
    same = rows.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    land_by_time(same, "ts", f"{path}/same", 5)
    assert spark.read.parquet(f"{path}/same/landing").count() == 1000


@pytest.mark.parametrize("largest,wide", [(5.0, False), (None, False), (1e9, True), (float("nan"), True)])
def test_sums_of_small_money_are_those_of_money(spark, largest, wide):
    from tidepool.plans import marts
    amounts = [0.005, 1.115, -3.335, 99999.99, None] + [largest]
    rows = spark.createDataFrame([(x,) for x in amounts], "value double")
    small = marts._small_money(rows, "value")
    assert rows.select(small.alias("m")).schema["m"].dataType.precision == (18 if wide else 8)
    rows = rows.filter("value is null or not isnan(value)")
    sums = rows.agg(F.sum(small).cast(marts.MONEY_SUM).alias("a"), F.sum(marts._money("value")).alias("b"))
    assert sums.schema["a"].dataType == sums.schema["b"].dataType and len(set(sums.first())) == 1
