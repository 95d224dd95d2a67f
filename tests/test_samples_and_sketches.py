"""Bottom-k samples and stored sketches."""

from pyspark.sql import functions as F

from tidepool.operators import sampling, sketches
from tidepool.session import scratch_path


def people(spark, n=3000):
    # One stratum holds a third of the rows; one is NULL; one is smaller than the sample.
    return spark.range(n).select("id", F.expr(
        "CASE WHEN id < 5 THEN 'small' WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
        "ELSE concat('s', id % 5) END AS g"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_sample_has_its_size_and_ignores_the_partitioning(spark):
    df = people(spark)
    a = sampling.bottom_k(df, ["g"], ["id"], 10, seed=3)
    assert ids(a) == ids(sampling.bottom_k(df.repartition(13), ["g"], ["id"], 10, seed=3))
    sizes = {r.g: r["count"] for r in a.groupBy("g").count().collect()}
    assert sizes == {"small": 5, "hot": 10, None: 10, **{f"s{i}": 10 for i in range(5)}}
    assert ids(a) != ids(sampling.bottom_k(df, ["g"], ["id"], 10, seed=4))


def test_sample_of_a_union_comes_from_the_samples(spark):
    df = people(spark)
    left, right = df.filter("id % 4 = 0"), df.filter("id % 4 <> 0")
    parts = [sampling.bottom_k(p, ["g"], ["id"], 10) for p in (left, right)]
    assert ids(sampling.merge_samples(*parts, ["g"], ["id"], 10)) == ids(sampling.bottom_k(df, ["g"], ["id"], 10))


def test_weights_add_up_to_the_rows(spark):
    df = people(spark)
    w = sampling.with_weights(sampling.bottom_k(df, ["g"], ["id"], 10), df, ["g"])
    assert abs(w.agg(F.sum("weight")).first()[0] - 3000) < 1e-6
    empty = df.limit(0)
    assert sampling.with_weights(sampling.bottom_k(empty, ["g"], ["id"], 10), empty, ["g"]).count() == 0


def test_map_tasks_pass_on_at_most_n_rows_a_stratum(spark):
    plan = sampling.bottom_k(people(spark), ["g"], ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    before = plan.rfind("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and plan.find("Exchange") < before


def test_days_stored_twice_count_once_and_ranges_merge(spark):
    path = scratch_path(spark, "sketches")
    df = spark.range(40_000).select(
        F.expr("date_add(date'2024-01-01', CAST(id % 4 AS INT))").alias("day"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'cold' END").alias("g"),
        F.expr("CASE WHEN id % 10 = 0 THEN NULL ELSE id % 9000 END").alias("u"),
        F.expr("concat('x', id % 50)").alias("t"))
    values = {"us": "u", "ts": "t"}
    sketches.store_daily(df.filter("day <= '2024-01-03'"), path, "day", ["g"], values)
    sketches.store_daily(df.filter("day >= '2024-01-03'"), path, "day", ["g"], values)
    stored = spark.read.parquet(path)
    assert stored.count() == 8
    got = sketches.estimates(sketches.merge_sketches(stored, ["g"], list(values)), list(values))
    want = {r.g: r for r in df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("u"),
                                                F.countDistinct("t").alias("t")).collect()}
    for r in got.collect():
        assert r.n_rows == want[r.g].n
        assert abs(r.us - want[r.g].u) <= sketches.relative_error(sigmas=4) * want[r.g].u
        assert r.ts == want[r.g].t


def test_only_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a", None), (None, "a", None)], "day date, g string, u long")
    path = scratch_path(spark, "null_sketches")
    sketches.store_daily(df, path, "day", ["g"], {"us": "u"})
    row = sketches.estimates(spark.read.parquet(path), ["us"]).first()
    assert (row.day, row.g, row.n_rows, row.us) == (None, "a", 2, 0)
    assert sketches.sketch_by(df.limit(0), ["day", "g"], {"us": "u"}).count() == 0
