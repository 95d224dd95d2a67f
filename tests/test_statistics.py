"""Column statistics and cost-based join order."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidepool.operators.statistics import COST_CONF, CostBased, estimated_rows, join_order
from tidepool.plans.layouts import ANALYZED, FILTERED, sales_of_small_parts
from tidepool.session import scratch_path
from tidepool.sources.tables import table

SF = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "customer", "part")


def _read(plan):
    return [p.rsplit("/", 1)[-1].split(".")[0] for p in join_order(plan)]


def test_statistics_change_the_join_order_and_no_row(spark):
    as_written = sales_of_small_parts(lambda name: table(spark, SF, name))
    assert _read(as_written) == ["lineitem", "orders", "customer", "part"]
    with CostBased(spark, {t: f"{SF}/{t}.parquet" for t in TABLES}) as cost:
        blind = sales_of_small_parts(cost.table)
        assert _read(blind) == ["lineitem", "orders", "customer", "part"]  # no statistics yet
        for t in TABLES:
            cost.analyze(t, ANALYZED[t], FILTERED[t])
        planned = sales_of_small_parts(cost.table)
    order = _read(planned)
    assert order.index("part") < order.index("orders") and sorted(order) == sorted(TABLES)
    assert sorted(map(tuple, planned.collect())) == sorted(map(tuple, as_written.collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows: nine in ten have v below 10, the others spread up to 1,000; every eighth n is NULL."""
    path = scratch_path(spark, "skewed_values")
    spark.range(4000).select(
        "id", F.expr("CASE WHEN id % 10 < 9 THEN id % 10 ELSE id % 1000 END").alias("v"), F.expr("IF(id % 8 = 0, NULL, id)").alias("n"),
        F.expr("concat('t', id % 7)").alias("a`b"), F.expr("CAST(NULL AS INT)").alias("empty"), F.expr("array(id)").alias("many")).write.parquet(path)
    return path


def test_histograms_know_skewed_values(spark, skewed):
    real = spark.read.parquet(skewed).filter("v < 10").count()
    estimates = {}
    for histograms in (True, False):
        with CostBased(spark, {"t": skewed}) as cost:
            cost.analyze("t", ["v"], histograms=["v"] if histograms else [])
            estimates[histograms] = estimated_rows(cost.table("t").filter("v < 10"))
    assert abs(estimates[True] - real) <= 0.05 * real
    assert estimates[False] < 0.1 * real  # least and greatest value alone suggest an even spread


def test_statistics_rows(spark, skewed):
    with CostBased(spark, {"t": skewed}) as cost:
        assert estimated_rows(cost.table("t")) is None
        cost.analyze("t", ["n", "a`b", "empty"], histograms=["id"])
        got = {r["column"]: r for r in cost.statistics("t", ["id", "n", "a`b", "empty", "v", "many"]).collect()}
    assert {r["rows"] for r in got.values()} == {4000}
    assert (got["id"]["min"], got["id"]["max"], got["id"]["nulls"]) == ("0", "3999", 0)
    assert got["n"]["nulls"] == 500 and got["a`b"]["distinct_estimate"] == 7 and got["a`b"]["bins"] is None
    assert got["empty"]["nulls"] == 4000 and got["empty"]["min"] is None
    assert got["id"]["bins"] == 254 and got["n"]["bins"] is None
    assert got["v"]["distinct_estimate"] is None and got["many"]["min"] is None


def test_every_column_that_can_have_statistics(spark, skewed):
    path = scratch_path(spark, "no_arrays")
    spark.read.parquet(skewed).drop("many").write.parquet(path)
    with CostBased(spark, {"t": path}) as cost:
        cost.analyze("t")
        assert {r["nulls"] for r in cost.statistics("t", ["id", "v", "n"]).collect()} == {0, 500}


def test_an_empty_table(spark):
    path = scratch_path(spark, "empty_statistics")
    spark.createDataFrame([], "k long, v string").write.parquet(path)
    with CostBased(spark, {"t": path}) as cost:
        cost.analyze("t", ["k", "v"])
        assert estimated_rows(cost.table("t")) == 0
        rows = cost.statistics("t", ["k", "v"]).collect()
    assert [(r["rows"], r["nulls"], r["min"]) for r in rows] == [(0, 0, None)] * 2


def test_the_callers_session_is_left_alone(spark, skewed):
    before = {k: spark.conf.get(k) for k in COST_CONF}
    tables = {t.name for t in spark.catalog.listTables()}
    with CostBased(spark, {"t": skewed}) as cost:
        cost.analyze("t", ["id"])
        df = cost.table("t").filter("id < 100")
        assert cost.statistics("t", ["id"]).sparkSession is spark
    assert SparkSession.getActiveSession() is spark
    assert {k: spark.conf.get(k) for k in COST_CONF} == before
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert df.count() == 100 and estimated_rows(df) == pytest.approx(100, abs=20)  # the table is dropped, its files are not
