"""Writes that delete, drains without a limit, layouts of any type."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepool.session import scratch_path


def test_emptied_bucket_leaves_no_row(spark):
    from tidepool.operators.merge import WhenMatched, merge_into_buckets, write_bucketed
    path = scratch_path(spark, "emptied")
    df = spark.createDataFrame([(i, "x") for i in range(6)], "k int, v string")
    write_bucketed(df, path, ["k"], 4)
    merge_into_buckets(spark, path, df.filter("k < 5"), ["k"], [WhenMatched(delete=True)], 4, path + "_stage")
    assert [r.k for r in spark.read.parquet(path).collect()] == [5]


def test_replace_where_leaves_no_old_row(spark):
    from tidepool.sources.sinks import replace_where
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "p int, v string")
    new = spark.createDataFrame([(2, "n")], "p int, v string")
    assert sorted(r.v for r in replace_where(old, new, F.col("p") == 1).collect()) == ["c", "d"]


def test_drain_raises_at_its_limit_and_keeps_all_reports(spark):
    from tidepool.streaming.runner import drain, progress_frame
    base = scratch_path(spark, "drain")
    spark.range(1500).repartition(150).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    with pytest.raises(TimeoutError):
        drain(stream, f"{base}/out0", f"{base}/ck0", timeout_s=1)
    q = drain(stream, f"{base}/out", f"{base}/ck")
    assert spark.read.parquet(f"{base}/out").count() == 1500
    assert progress_frame(spark, q).filter("num_input_rows > 0").count() == 150


def test_loader_takes_every_suffix_and_raises_on_a_bad_ledger(spark):
    from tidepool.sources.files import copy_into, read_loaded
    base = scratch_path(spark, "suffix")
    spark.range(10).write.option("compression", "gzip").json(f"{base}/json")
    schema = spark.range(1).schema
    assert copy_into(spark, f"{base}/json", "json", schema, f"{base}/t", f"{base}/l") > 0
    assert read_loaded(spark, f"{base}/t").count() == 10
    spark.range(4).select(F.col("id").cast("string").alias("value")).write.text(f"{base}/txt")
    assert copy_into(spark, f"{base}/txt", "text", spark.read.text(f"{base}/txt").schema, f"{base}/t2", f"{base}/l2") > 0
    spark.range(3).write.json(f"{base}/l3")  # not a ledger
    with pytest.raises(Exception):
        copy_into(spark, f"{base}/json", "json", schema, f"{base}/t3", f"{base}/l3")


@pytest.mark.parametrize("kind", ["date", "text"])
def test_zorder_keeps_days_and_texts_together(spark, kind):
    from tidepool.operators import layout as lay
    base = scratch_path(spark, "locality")
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int") % 1000)
    df = spark.range(20_000).select((day if kind == "date" else day.cast("string")).alias("d"), (F.col("id") * 7919 % 100).alias("n"))
    lay.zorder(df, ["d", "n"], f"{base}/z", num_files=16)
    spans = lay.file_stats(spark, f"{base}/z", ["d"]).select("rows", F.datediff(F.col("d_max").cast("date"), F.col("d_min").cast("date")).alias("days")).collect()
    assert sum(r.rows for r in spans) == 20_000 and sum(r.days for r in spans) / len(spans) < 500
    report = lay.skipping_report(spark, f"{base}/z", {"d": dt.date(2021, 1, 1) if kind == "date" else "2021-01-01"}).first()
    assert report.files_to_read < report.total_files and report.probe_rows == 20


def test_null_keys_keep_their_rows(spark, tmp_path):
    from tidepool.plans.windows import first_last_value
    orders = spark.createDataFrame([(1, None, 5.0, dt.datetime(2020, 1, 1)), (2, None, 7.0, dt.datetime(2020, 1, 2)), (3, 4, 1.0, dt.datetime(2020, 1, 1))],
                                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    rows = {r.o_orderkey: (r.first_amount, r.last_amount) for r in first_last_value(spark, str(tmp_path)).collect()}
    assert rows == {1: (5.0, 7.0), 2: (5.0, 7.0), 3: (1.0, 1.0)}
