"""Property test: the segmented scan equals Spark's windows on random data."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.scan import keyed_running

rows_strategy = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, 3, None]),            # key 0 is hot; NULL keys too
              st.one_of(st.none(), st.integers(0, 6)),             # order value with NULLs and ties
              st.integers(-50, 50)),                               # value
    min_size=1, max_size=120)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, parts=st.integers(1, 9), batch=st.sampled_from([3, 7, 1000]), spread=st.booleans())
def test_scan_equals_windows(spark, rows, parts, batch, spread):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        data = [(k, o, v, i) for i, (k, o, v) in enumerate(rows)]
        df = spark.createDataFrame(data, "k int, o int, v int, i long")
        got = keyed_running(df, ["k"], ["o", "i"], sums=[("v", "s")], row_number="rn", rank="rk",
                         dense_rank="drk", lags=[("v", "prev_v")], ffill=[("o", "fo")], rank_by=1,
                         num_partitions=parts, spread=spread)
        w = Window.partitionBy("k").orderBy(F.col("o").asc_nulls_first(), "i")
        wr = w.rowsBetween(Window.unboundedPreceding, 0)
        wo = Window.partitionBy("k").orderBy(F.col("o").asc_nulls_first())
        want = (df.withColumn("s", F.sum("v").over(wr))
                .withColumn("rn", F.row_number().over(w)).withColumn("rk", F.rank().over(wo))
                .withColumn("drk", F.dense_rank().over(wo)).withColumn("prev_v", F.lag("v").over(w))
                .withColumn("fo", F.last("o", ignorenulls=True).over(wr)))
        cols = ["i", "s", "rn", "rk", "drk", "prev_v", "fo"]
        a = sorted(tuple(r) for r in got.select(*cols).collect())
        b = sorted(tuple(r) for r in want.select(*cols).collect())
        assert a == b
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("spread", [True, False])
def test_sums_keep_their_type(spark, spread):
    """BIGINT above 2**53 and DECIMAL sums are exact and of the type of Spark's window; so are maxima."""
    df = spark.range(40).selectExpr("id % 2 AS k", "id AS i", "9007199254740993 + id AS b", "CAST(id AS DECIMAL(20, 4)) / 7 AS d", "IF(id % 3 = 0, NULL, 100 - id) AS m")
    got = keyed_running(df, ["k"], ["i"], sums=[("b", "sb"), ("d", "sd")], maxes=[("m", "mm")], num_partitions=6, spread=spread)
    w = Window.partitionBy("k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"sb": F.sum("b").over(w), "sd": F.sum("d").over(w), "mm": F.max("m").over(w)})
    assert got.select("i", "sb", "sd", "mm").schema == want.select("i", "sb", "sd", "mm").schema
    assert sorted(got.select("i", "sb", "sd", "mm").collect()) == sorted(want.select("i", "sb", "sd", "mm").collect())
