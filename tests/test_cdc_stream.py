"""The spliced history after any batches equals the batch operator's over all changes; batches cost the same."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.test_cdc_properties import brute
from tidepool.operators import scan
from tidepool.operators.scd import auto_cdc_scd2
from tidepool.session import scratch_path
from tidepool.streaming import cdc
from tidepool.streaming.cdc import CdcTable

SCHEMA = "id int, seq int, tier string, points int, op string"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("id", "tier", "points", "__START_AT", "__END_AT").collect()), key=repr)


def options():
    return {"tracked": ["tier"], "except_cols": ["op"], "delete_when": F.col("op") == "D"}


def changes(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, "a", "b"]), rng.choice([None, *range(9)]), rng.choice("UUUD")) for _ in range(n)]


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("seed,shuffled", [(0, True), (2, False)])
def test_batches_in_any_order(spark, seed, shuffled, spread, monkeypatch):
    for module in (scan, cdc):
        monkeypatch.setattr(module, "ONE_TASK_BYTES", -1 if spread else 64 << 20)
    rows = changes(seed, 36)
    data = [(k, seq, tier, pts, op) for seq, (k, tier, pts, op) in enumerate(rows)]
    if shuffled:
        random.Random(seed).shuffle(data)
    table = CdcTable(spark.createDataFrame([], SCHEMA), ["id"], "seq", scratch_path(spark, "cdc"), 4, **options())
    size = 12
    for b in range(0, len(data), size):
        table.apply(spark.createDataFrame(data[b:b + size], SCHEMA).coalesce(2), b // size)
        assert rows_of(table.history()) == brute(sorted(data[:b + size], key=lambda r: r[1]), numbered=True), b


def test_a_batch_that_runs_again(spark):
    """After each write of a batch the rest may be lost: the replay gives the same rows."""
    rows = changes(7, 30)
    data = [(k, seq, tier, pts, op) for seq, (k, tier, pts, op) in enumerate(rows)]
    batches = [data[:10], data[14:24], data[10:14] + data[24:]]
    table = CdcTable(spark.createDataFrame([], SCHEMA), ["id"], "seq", scratch_path(spark, "cdc"), 4, **options())
    for i, rows_ in enumerate(batches):
        df = spark.createDataFrame(rows_, SCHEMA).coalesce(2)
        table.apply(df, i)
        table.apply(df, i)
    assert rows_of(table.history()) == brute(rows)


def test_ties_follow_the_stated_order(spark):
    """Equal sequence values: by tie_break, then updates before deletes; in one batch or in several."""
    data = [(1, 1, "a", 1, "U"), (1, 2, "b", 5, "U"), (1, 2, "c", 4, "U"), (1, 2, "c", 4, "U"), (2, 3, "x", 1, "D"), (2, 3, "x", 1, "U"), (3, 1, "k", 1, "U")]
    want = [(1, "a", 1, 1, 2), (1, "b", 5, 2, None), (1, "c", 4, 2, 2), (2, "x", 1, 3, 3), (3, "k", 1, 1, None)]
    opts = {**options(), "tie_break": ["points"]}
    assert rows_of(auto_cdc_scd2(spark.createDataFrame(data, SCHEMA), ["id"], "seq", **opts)) == want
    assert rows_of(auto_cdc_scd2(spark.createDataFrame(data[::-1], SCHEMA).repartition(3), ["id"], "seq", **opts)) == want
    table = CdcTable(spark.createDataFrame([], SCHEMA), ["id"], "seq", scratch_path(spark, "cdc"), 2, **opts)
    for i, row in enumerate([data[i:i + 2] for i in (4, 0, 5, 2)]):
        table.apply(spark.createDataFrame(row, SCHEMA).coalesce(1), i)
    assert rows_of(table.history()) == want


def test_in_order_batches_cost_the_same(spark):
    """Batch 20 takes what batch 2 takes (median of three against median of three), and reads no change of an earlier batch."""
    table = CdcTable(spark.createDataFrame([], SCHEMA), ["id"], "seq", scratch_path(spark, "cdc"), 2, **options())
    took = []
    for b in range(13):
        df = spark.range(2000).select((F.col("id") % 50).cast("int").alias("id"), (F.col("id") + 2000 * b).cast("int").alias("seq"),
                                      F.concat(F.lit("t"), (F.col("id") + b) % 3).alias("tier"), F.col("id").cast("int").alias("points"), F.lit("U").alias("op"))
        began = time.time()
        table.apply(df, b)
        took.append(time.time() - began)
    early, lately = sorted(took[2:6])[1], sorted(took[-4:])[1]
    assert lately <= 1.5 * early, took
    assert table.history().count() == auto_cdc_scd2(spark.read.parquet(f"{table.path}/changes").select("id", F.col("_seq").alias("seq"), "tier", "points"), ["id"], "seq", tracked=["tier"]).count()
