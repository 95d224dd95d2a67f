"""Property test: the merge operator equals a brute-force MERGE on random data."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.operators.merge import WhenMatched, WhenNotMatched, WhenNotMatchedBySource, merge
from tidepool.operators.skew import frequent_hashes

keys = st.one_of(st.none(), st.integers(0, 15))
target_s = st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=25)
source_s = st.lists(st.tuples(keys, st.integers(-5, 5)), max_size=20)


def brute(target, source):
    """Ordered clauses: matched -> delete if s.v < 0, update if s.v > t.v, else keep;
    not matched -> insert if s.v is even; not matched by source -> delete if t.v == 0."""
    by_key = {}
    for k, v in source:
        if k is not None:
            by_key[k] = v
    out, matched_keys = [], set()
    for k, tv in target:
        if k is not None and k in by_key:
            matched_keys.add(k)
            sv = by_key[k]
            if sv < 0:
                continue
            out.append((k, sv) if sv > tv else (k, tv))
        elif tv == 0:
            continue
        else:
            out.append((k, tv))
    for k, sv in source:
        target_keys = {tk for tk, _ in target if tk is not None}
        if (k is None or k not in target_keys) and sv % 2 == 0:
            out.append((k, sv))
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=target_s, source=source_s, spread=st.booleans())
def test_merge_equals_brute_force(spark, target, source, spread):
    # source keys must be unique among non-NULL keys (a MERGE with matched clauses requires it)
    seen, src = set(), []
    for k, v in source:
        if k is None or k not in seen:
            src.append((k, v))
            seen.add(k)
    t = spark.createDataFrame(target, "k int, v int")
    s = spark.createDataFrame(src, "k int, v int")
    clauses = [WhenMatched("s.v < 0", delete=True), WhenMatched("s.v > t.v", update="*"),
               WhenNotMatched("s.v % 2 = 0"), WhenNotMatchedBySource("t.v = 0", delete=True)]
    got = sorted((tuple(r) for r in merge(t, s, ["k"], clauses, spread_hot_keys=spread).collect()), key=repr)
    assert got == brute(target, src)
    clauses2 = clauses[:3]
    got2 = sorted((tuple(r) for r in merge(t, s, ["k"], clauses2, spread_hot_keys=spread).collect()), key=repr)
    want2 = brute(target, src)
    kept_zero = [(k, v) for k, v in target if v == 0 and (k is None or k not in {sk for sk, _ in src
                                                                                   if sk is not None})]
    assert got2 == sorted(want2 + kept_zero, key=repr)


def _spark_tasks(df, spark, hot):
    """In how many partitions of the result the rows of a key lie."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "128")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.filter(F.col("k") == hot).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


HOT = [WhenMatched("s.v < 0", delete=True), WhenMatched("s.v > t.v", update="*"), WhenNotMatched(), WhenNotMatchedBySource("t.v = 0", delete=True)]


def test_hot_target_key_is_spread(spark):
    """A third of the target in one key, all of them equal rows in many files: at least 50 tasks, and the rows of a plain merge."""
    t = spark.range(0, 30_000, 1, 200).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.lit(1).alias("v"))
    s = spark.createDataFrame([(7, 5), (101, -1), (102, 0), (-3, 4), (None, 2)], "k long, v int")
    spread, plain = merge(t, s, ["k"], HOT, spread_hot_keys=True), merge(t, s, ["k"], HOT, spread_hot_keys=False)
    rows = Counter(map(tuple, spread.collect()))
    assert rows == Counter(map(tuple, plain.collect())) and rows[7, 5] == 10_000 and rows[-3, 4] == rows[None, 2] == 1
    assert _spark_tasks(plain, spark, 7) == 1 and _spark_tasks(spread, spark, 7) >= 50


def test_hot_source_key_is_spread(spark):
    """A source key with a third of the rows that the target lacks: all are inserted, from many tasks."""
    s = spark.range(0, 9_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").cast("int").alias("v"))
    t = spark.createDataFrame([(101, 0), (5, 0), (6, 2)], "k long, v int")
    spread, plain = merge(t, s, ["k"], HOT, spread_hot_keys=True), merge(t, s, ["k"], HOT, spread_hot_keys=False)
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))
    assert _spark_tasks(spread, spark, 7) >= 50


def test_frequent_hashes_are_bounded_and_exact_enough(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 4 == 0, 0).when(F.col("id") % 4 == 1, F.col("id") % 8).otherwise(F.col("id")).alias("k"))
    found = frequent_hashes(df, ["k"])
    counts = sorted(found.values())
    assert len(counts) == 3 and counts[-1] >= 25_000 and all(12_000 <= c <= 13_000 for c in counts[:2])
    assert frequent_hashes(df.limit(0), ["k"]) == {} == frequent_hashes(spark.range(1000).withColumnRenamed("id", "k"), ["k"])


@pytest.mark.parametrize("spread", [True, False])
def test_map_columns_merge(spark, spread):
    """Maps and structs of maps ride along; they are no part of a salt."""
    rows = "SELECT id AS k, map('a', id) AS m, named_struct('x', array(map(1, id))) AS n FROM range({})"
    t, s = spark.sql(rows.format(4)), spark.sql(rows.format("2, 6")).withColumn("m", F.expr("map('b', k)"))
    s = s.union(spark.sql("SELECT CAST(NULL AS BIGINT), map('c', 1L), named_struct('x', array(map(1, 1L)))"))
    got = merge(t, s, ["k"], [WhenMatched(update="*"), WhenNotMatched()], spread_hot_keys=spread).collect()
    assert sorted((str(r.k), *r.m) for r in got) == [("0", "a"), ("1", "a"), ("2", "b"), ("3", "b"), ("4", "b"), ("5", "b"), ("None", "c")]
    inserted = merge(t, s, ["k"], [WhenNotMatched()], spread_hot_keys=spread).collect()
    assert sorted((str(r.k), *r.m) for r in inserted) == [("0", "a"), ("1", "a"), ("2", "a"), ("3", "a"), ("4", "b"), ("5", "b"), ("None", "c")]
