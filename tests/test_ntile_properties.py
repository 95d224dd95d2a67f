"""Property test: the distributed ntile equals Spark's single-window ntile."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.relational import global_ntile


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=150), n=st.integers(1, 9),
       parts=st.integers(1, 7))
def test_global_ntile_equals_window(spark, values, n, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v int")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = global_ntile(df.repartition(parts), n, order, "b")
    want = df.withColumn("b", F.ntile(n).over(Window.orderBy(*order)).cast("long"))
    assert sorted(tuple(r) for r in got.select("id", "b").collect()) == \
        sorted(tuple(r) for r in want.select("id", "b").collect())
