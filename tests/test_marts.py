"""Jobs whose marts come from one run (their rows are held against SQL in test_queries)."""

import os

from pyspark.sql import functions as F

from tidepool.plans import marts
from tidepool.plans.pipelines import events_silver, payments_silver
from tidepool.sources.tables import Tables, table

SF = "/root/testdata/sf0.001"


def test_stacked_marts_keep_every_row_and_fill_columns_with_null(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "k int, a string")
    b = spark.createDataFrame([(2, 0.5)], "k int, b double")
    empty = spark.createDataFrame([], "c date")
    got = marts.stacked({"a": a, "b": b, "none": empty})
    assert got.columns == ["mart", "k", "a", "b", "c"]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted([("a", 1, "x", None, None)] * 2 + [("a", None, None, None, None), ("b", 2, None, 0.5, None)], key=repr)


def test_silver_keeps_the_first_arrival_of_every_event(spark):
    events = table(spark, SF, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    for silver in (spark.read.parquet(f"{payments_silver(spark, SF)}/silver"), events_silver(spark, SF)[1]):
        kept = silver.select("event_id", "ts")
        assert kept.exceptAll(events).isEmpty() and events.exceptAll(kept).isEmpty()


def test_dimension_changes_reach_every_case(spark):
    first, second = marts.dimension_changes(Tables(spark, SF), *marts.DIMENSIONS["customers"])
    old = {r[0]: r["segment"] for r in first.collect()}
    new = {r[0]: (r["segment"], r["operation"]) for r in second.collect()}
    kinds = {"unchanged": set(old) - set(new), "inserted": {k for k, v in new.items() if v[1] == "UPSERT"} - set(old),
             "deleted": {k for k, v in new.items() if v[1] == "DELETE"} & set(old),
             "changed": {k for k in set(old) & set(new) if old[k] != new[k][0] and new[k][1] == "UPSERT"},
             "deleted, never seen": {k for k, v in new.items() if v[1] == "DELETE"} - set(old)}
    assert all(kinds.values()), {k: len(v) for k, v in kinds.items()}


def test_retail_facts_meet_current_dimension_rows_once(spark):
    got = marts.retail_job(spark, SF)
    lines = table(spark, SF, "lineitem").filter("l_quantity > 2 AND l_extendedprice > 0").count()
    sold = got["product_sales"].agg(F.sum("n_lines")).first()[0]
    returned = got["returns"].agg(F.sum("n_lines")).first()[0]
    assert sold + returned == lines  # no join repeats or loses a line
    for name in ("store_days", "customers"):
        assert got[name].agg(F.sum("n_lines")).first()[0] == sold
    # Every mart is a written table of one run's folder.
    folders = {os.path.dirname(os.path.dirname(f)) for n in ("product_sales", "store_days", "customers", "returns") for f in got[n].inputFiles()}
    assert len(folders) == 1
