"""Change logs in files."""

import re

import pytest
from pyspark.sql import functions as F

from tidepool.operators import change_table as ct
from tidepool.operators import changelog as cl
from tidepool.session import scratch_path

TS = "2024-01-{:02d} 00:00:00"


@pytest.fixture(scope="module")
def logged(spark):
    """Twelve versions over 300 keys, and the rows after each as brute force has them."""
    path, state, states = scratch_path(spark, "change_table"), {}, []
    for v in range(12):
        rows = []
        for k in range(300):
            if v == 0 or (k * 7 + v) % 11 == 0:
                old = state.get(k)
                if old is not None and k % 5 == 0:
                    rows.append((k, old, cl.DELETE))
                    del state[k]
                    continue
                if old is not None:
                    rows.append((k, old, cl.PRE))
                state[k] = f"{k}-{v}" if k % 3 else "same"
                rows.append((k, state[k], cl.INSERT if old is None else cl.POST))
        df = spark.createDataFrame(rows, "k int, x string, _change_type string")
        changes = df.select("*", F.lit(v).cast("long").alias("_commit_version"), F.lit(TS.format(v + 1)).cast("timestamp_ntz").alias("_commit_timestamp"))
        for _ in range(2 if v == 7 else 1):  # version 7 is replayed
            ct.append_changes(changes, path, ["k"], v, snapshot_every=4)
        states.append(dict(state))
    return path, states


def pairs(df):
    return sorted((r.k, r.x) for r in df.collect())


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_version_is_read_back(spark, logged):
    path, states = logged
    assert ct.snapshot_versions(spark, path) == [0, 4, 8]
    for v in (0, 3, 4, 7, 11):
        assert pairs(ct.state_at(spark, path, ["k"], v)) == sorted(states[v].items())


def test_an_unfinished_snapshot_is_not_used(spark, logged):
    path, states = logged
    spark.createDataFrame([(1, "wrong")], "k int, x string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
         .parquet(f"{path}/snapshots/version=6")
    assert ct.snapshot_versions(spark, path) == [0, 4, 8]
    assert pairs(ct.state_at(spark, path, ["k"], 6)) == sorted(states[6].items())


def test_old_versions_are_pruned(spark, logged):
    path, _ = logged
    feed = ct.read_changes(spark, path, 9)
    assert len(feed.inputFiles()) > 0 and re.search(r"PartitionFilters: \[[^\]]*_commit_version[^\]]*>= 9", scans(feed))
    read = {r[0] for r in feed.select(F.regexp_extract(F.input_file_name(), r"_commit_version=(\d+)", 1)).distinct().collect()}
    assert read == {"9", "10", "11"}
    assert scans(ct.state_at(spark, path, ["k"], 8)).count("FileScan") == 1
    assert scans(ct.state_at(spark, path, ["k"], 10)).count("FileScan") == 2


def test_differences_and_undo(spark, logged):
    path, states = logged
    net = ct.net_changes(spark, path, ["k"], 2, 9).collect()
    a, b = set(states[2].items()), set(states[9].items())
    assert sorted((r.k, r.x) for r in net if r._side == "added") == sorted(b - a)
    assert sorted((r.k, r.x) for r in net if r._side == "removed") == sorted(a - b)
    want = {k: states[5].get(k, x) if k % 2 else x for k, x in states[10].items()}
    assert pairs(ct.undo(spark, path, ["k"], 10, F.col("k") % 2 == 1, 5)) == sorted(want.items())


def test_versions_by_time(spark, logged):
    path, _ = logged
    assert ct.version_at(spark, path, "2024-01-05 10:00:00") == 4
    assert ct.version_at(spark, path, "2023-01-01 00:00:00") is None


def test_feed_without_preimages_gives_the_same_states(spark, logged):
    path, states = logged
    bare = scratch_path(spark, "change_table_bare")
    for v in range(4):
        ct.append_changes(ct.read_changes(spark, path, v, v), bare, ["k"], v, capture=False, snapshot_every=None)
    assert ct.read_changes(spark, bare).filter(F.col("_change_type") == cl.PRE).count() == 0
    assert pairs(ct.state_at(spark, bare, ["k"], 3)) == sorted(states[3].items())


def test_propagation_takes_at_most_four_scans(spark):
    from tidepool.plans.changelogs import cdf_propagate_written
    assert scans(cdf_propagate_written(spark, "/root/testdata/sf0.001")).count("FileScan") <= 4
