"""Edge semantics on small literal fixtures (the cases the exercises assert)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import changelog as cl
from tidepool.operators import layout as lay
from tidepool.operators import quality as q
from tidepool.operators.merge import (MergeAmbiguityError, MergeBuilder, WhenMatched, WhenNotMatched,
                                      WhenNotMatchedBySource, merge)
from tidepool.operators.relational import global_ntile, latest_per_key, salted_agg
from tidepool.operators.scd import auto_cdc_scd2, scd2_merge
from tidepool.operators.windows import sessionize
from tidepool.session import scratch_path

TS = dt.datetime


def srt(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, amount double, status string, updated_at timestamp")


def as_dict(df, key="order_id"):
    return {r[key]: r.asDict() for r in df.collect()}


# ---------------------------------------------------------------- merge

def test_upsert_updates_and_inserts(spark):
    t = orders(spark, [("ORD-001", 99.5, "pending", TS(2024, 1, 1)), ("ORD-002", 10.0, "shipped", TS(2024, 1, 1))])
    s = orders(spark, [("ORD-001", 109.5, "shipped", TS(2024, 1, 2)), ("ORD-003", 5.0, "pending", TS(2024, 1, 2))])
    out = as_dict(MergeBuilder(t, s, ["order_id"]).whenMatchedUpdateAll().whenNotMatchedInsertAll().execute())
    assert len(out) == 3 and out["ORD-001"]["amount"] == 109.5 and out["ORD-002"]["amount"] == 10.0


def test_ordered_clauses_first_match_wins_and_no_clause_keeps(spark):
    t = orders(spark, [("A", 1.0, "pending", TS(2024, 1, 5)), ("B", 2.0, "pending", TS(2024, 1, 5)),
                       ("C", 3.0, "pending", TS(2024, 1, 5))])
    s = orders(spark, [("A", 9.0, "cancelled", TS(2024, 1, 9)), ("B", 8.0, "shipped", TS(2024, 1, 1)),
                       ("C", 7.0, "shipped", TS(2024, 1, 9)), ("D", 6.0, "new", TS(2024, 1, 9))])
    out = as_dict(merge(t, s, ["order_id"], [
        WhenMatched("s.status = 'cancelled'", delete=True),
        WhenMatched("s.updated_at > t.updated_at", update="*"),
        WhenNotMatched()]))
    assert set(out) == {"B", "C", "D"}
    assert out["B"]["amount"] == 2.0  # older source row: no clause holds, target kept
    assert out["C"]["amount"] == 7.0


def test_ambiguous_source_raises(spark):
    t = orders(spark, [("A", 1.0, "p", TS(2024, 1, 1))])
    s = orders(spark, [("A", 2.0, "p", TS(2024, 1, 2)), ("A", 3.0, "p", TS(2024, 1, 3))])
    with pytest.raises(MergeAmbiguityError):
        merge(t, s, ["order_id"], [WhenMatched(update="*")]).collect()
    # deduplicating first (keep latest) resolves it
    out = as_dict(merge(t, latest_per_key(s, ["order_id"], ["updated_at"]), ["order_id"], [WhenMatched(update="*")]))
    assert out["A"]["amount"] == 3.0


def test_null_keys_never_match(spark):
    t = orders(spark, [(None, 1.0, "p", TS(2024, 1, 1))])
    s = orders(spark, [(None, 2.0, "p", TS(2024, 1, 2))])
    out = merge(t, s, ["order_id"], [WhenMatched(update="*"), WhenNotMatched()]).collect()
    assert sorted(r["amount"] for r in out) == [1.0, 2.0]


def test_empty_source_is_identity_and_by_source_delete(spark):
    t = orders(spark, [("A", 1.0, "p", TS(2024, 1, 1)), ("B", 2.0, "p", TS(2023, 1, 1))])
    empty = t.limit(0)
    assert srt(merge(t, empty, ["order_id"], [WhenMatched(update="*"), WhenNotMatched()]).collect()) == \
        srt(t.collect())
    out = merge(t, empty, ["order_id"], [WhenNotMatchedBySource("t.updated_at < TIMESTAMP '2024-01-01'",
                                                                delete=True)])
    assert [r["order_id"] for r in out.collect()] == ["A"]


def test_schema_evolution_adds_null_column(spark):
    t = orders(spark, [("A", 1.0, "p", TS(2024, 1, 1)), ("B", 2.0, "p", TS(2024, 1, 1))])
    s = orders(spark, [("A", 5.0, "p", TS(2024, 1, 2))]).withColumn("discount_pct", F.lit(0.1))
    out = as_dict(MergeBuilder(t, s, ["order_id"]).withSchemaEvolution().whenMatchedUpdateAll().execute())
    assert out["A"]["discount_pct"] == 0.1 and out["B"]["discount_pct"] is None


# ---------------------------------------------------------------- SCD

def _dim(spark):
    return spark.createDataFrame(
        [("C1", "Ann", "a@x", "EU", "gold", True, dt.date(2024, 1, 1), dt.date(9999, 12, 31)),
         ("C2", "Bob", None, "US", "silver", True, dt.date(2024, 1, 1), dt.date(9999, 12, 31)),
         ("C3", "Cy", "c@x", "EU", "bronze", True, dt.date(2024, 1, 1), dt.date(9999, 12, 31)),
         ("C4", "Di", "d@x", "APAC", "gold", True, dt.date(2024, 1, 1), dt.date(9999, 12, 31))],
        "customer_id string, name string, email string, region string, tier string, is_current boolean, "
        "effective_start_date date, effective_end_date date")


def test_scd2_nullsafe_change_and_rerun_is_identity(spark):
    dim = _dim(spark)
    batch = spark.createDataFrame([("C1", "Ann", "a@x", "EU", "platinum"), ("C2", "Bob", "b@x", "US", "silver"),
                                   ("C5", "Eve", "e@x", "EU", "bronze")],
                                  "customer_id string, name string, email string, region string, tier string")
    cols = ["name", "email", "region", "tier"]
    once = scd2_merge(dim, batch, ["customer_id"], cols, "2024-06-01")
    rows = once.collect()
    assert len(rows) == 7  # 4 + 2 new versions (C1 tier, C2 NULL->email) + 1 new key
    assert sum(r["is_current"] for r in rows) == 5
    twice = scd2_merge(once, batch, ["customer_id"], cols, "2024-07-01")
    assert srt(twice.collect()) == srt(rows)


def test_auto_cdc_out_of_order_ignore_nulls_and_untracked(spark):
    feed = spark.createDataFrame([
        (1, 3, "Ann", "x@a", 30), (1, 1, "Ann", "a@a", 10), (1, 2, None, None, 20),  # late + NULL update
        (1, 4, "Ann", "x@a", 40),                                                    # untracked change only
        (2, 1, "Bob", "b@b", 5), (2, 2, None, None, None)],
        "id int, seq int, name string, email string, points int")
    h = auto_cdc_scd2(feed, ["id"], "seq", tracked=["name", "email"]).orderBy("id", "__START_AT").collect()
    one = [r for r in h if r["id"] == 1]
    assert [(r["email"], r["__START_AT"], r["__END_AT"], r["points"]) for r in one] == \
        [("a@a", 1, 3, 20), ("x@a", 3, None, 40)]
    two = [r for r in h if r["id"] == 2]
    assert len(two) == 1 and two[0]["points"] == 5 and two[0]["__END_AT"] is None


def test_auto_cdc_delete_closes_version(spark):
    feed = spark.createDataFrame([(1, 1, "a", "U"), (1, 2, "a", "D"), (1, 3, "b", "U")],
                                 "id int, seq int, name string, op string")
    h = auto_cdc_scd2(feed, ["id"], "seq", tracked=["name"], except_cols=["op"],
                      delete_when=F.col("op") == "D").orderBy("__START_AT").collect()
    assert [(r["name"], r["__START_AT"], r["__END_AT"]) for r in h] == [("a", 1, 2), ("b", 3, None)]


# ---------------------------------------------------------------- change log

def test_restore_and_feed_invariants(spark):
    s0 = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "c", 30.0)], "k int, v string, x double")
    log = cl.commit_insert(s0, 0, "2024-01-01")
    log = log.unionByName(cl.commit_update(s0, F.col("k") == 1, {"x": F.lit(11.0)}, 1, "2024-01-02"))
    s1 = cl.as_of_version(log, ["k"], 1)
    log = log.unionByName(cl.commit_delete(s1, F.col("k") == 2, 2, "2024-01-03"))
    assert cl.as_of_version(log, ["k"], 0).count() == 3
    assert sorted(cl.as_of_version(log, ["k"], 2).collect()) == [(1, "a", 11.0), (3, "c", 30.0)]
    restore = cl.restore(log, ["k"], 0, 3, "2024-01-04")
    log3 = log.unionByName(restore)
    assert sorted(cl.as_of_version(log3, ["k"], 3).collect()) == sorted(s0.collect())
    # apply(feed since 1, state at 0) == state at 2
    applied = cl.apply_changes(cl.as_of_version(log, ["k"], 0), cl.changes_between(log, 1), ["k"])
    assert sorted(applied.collect()) == sorted(cl.as_of_version(log, ["k"], 2).collect())
    hist = {r["_commit_version"]: r["operation"] for r in cl.history(log3).collect()}
    assert hist == {0: "WRITE", 1: "UPDATE", 2: "DELETE", 3: "MERGE"}


# ---------------------------------------------------------------- quality

def test_rules_split_validate_and_add(spark):
    cand = spark.createDataFrame([("ORD-201", 49.99, "pending"), ("ORD-202", -10.0, "completed"),
                                  ("ORD-203", 75.0, None)], "order_id string, amount double, status string")
    rules = [q.not_null("status"), q.Rule("positive_amount", "amount > 0")]
    valid, rejected = q.split(cand, rules)
    assert [r["order_id"] for r in valid.collect()] == ["ORD-201"]
    assert {r["order_id"]: r["_failed_rules"] for r in rejected.collect()} == {
        "ORD-202": ["positive_amount"], "ORD-203": ["status_not_null"]}
    with pytest.raises(q.ConstraintViolation):
        q.validate(cand, rules)
    rs = q.RuleSet()
    with pytest.raises(q.ConstraintViolation):
        rs.add(q.Rule("positive_amount", "amount > 0"), existing=cand)
    rs.add(q.Rule("positive_amount", "amount > 0"), existing=valid)
    assert [tuple(r) for r in rs.to_df(spark).collect()] == [("positive_amount", "amount > 0")]
    rs.drop("positive_amount")
    assert rs.rules == []


def test_expect_fail_aborts(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    with pytest.raises(Exception):
        q.expect(df, {"positive": "x > 0"}, action="fail").collect()
    assert q.expect(df, {"positive": "x > 0"}, action="drop").count() == 1


def test_enforce_modes(spark):
    df = spark.createDataFrame([("1", "2.5", "extra")], "id string, amount string, note string")
    target = spark.createDataFrame([], "id string, amount double").schema
    with pytest.raises(q.SchemaMismatch):
        q.enforce(df, target, "strict")
    with pytest.raises(q.SchemaMismatch):
        q.enforce(df, target, "project")
    assert q.enforce(df, target, "cast").collect()[0]["amount"] == 2.5


# ---------------------------------------------------------------- nested / windows

def test_explode_outer_and_null_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, tags array<string>")
    assert df.select("id", F.explode_outer("tags")).count() == 4  # empty and NULL give one NULL row each
    assert df.select("id", F.explode("tags")).count() == 2
    sizes = {r["id"]: r["n"] for r in df.select("id", F.size("tags").alias("n")).collect()}
    assert sizes[3] is None or sizes[3] == -1


def test_session_gap_of_exactly_30_minutes_stays(spark):
    ev = spark.createDataFrame([(1, 1, TS(2024, 1, 1, 0, 0)), (2, 1, TS(2024, 1, 1, 0, 30)),
                                (3, 1, TS(2024, 1, 1, 1, 1)), (4, 2, TS(2024, 1, 1, 0, 0))],
                               "event_id int, user_id int, ts timestamp")
    out = {r["event_id"]: r["session_num"] for r in sessionize(ev, "user_id", "ts", "event_id", 30).collect()}
    assert out == {1: 1, 2: 1, 3: 2, 4: 1}


def test_global_ntile_matches_window_ntile(spark):
    df = spark.range(0, 1003).select((F.col("id") * 7919 % 1003).alias("k"), (F.col("id") % 17).alias("v"))
    order = [F.col("v").desc(), F.col("k").asc()]
    want = df.withColumn("b", F.ntile(7).over(Window.orderBy(*order)))
    got = global_ntile(df.repartition(5), 7, order, "b")
    assert sorted(got.select("k", "b").collect()) == sorted(want.select("k", "b").collect())


def test_salted_agg_equals_plain_agg(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("key"), F.col("id").alias("v"))
    hot = df.union(spark.range(0, 20000).select(F.lit(0).cast("long").alias("key"), F.col("id").alias("v")))
    got = salted_agg(hot, ["key"], {"s": F.sum("v"), "n": F.count("v")}, {"s": F.sum("s"), "n": F.sum("n")},
                     salt_by=["v"], buckets=8)
    want = hot.groupBy("key").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    assert sorted(got.collect()) == sorted(want.collect())


# ---------------------------------------------------------------- streaming, layout

def test_late_rows_after_watermark_are_dropped(spark):
    from tidepool.streaming.runner import drain
    base = scratch_path(spark, "late")
    schema = "id int, ts timestamp"
    spark.createDataFrame([(1, TS(2024, 1, 1, 10, 0)), (2, TS(2024, 1, 1, 12, 0))], schema) \
        .write.parquet(f"{base}/in/b1")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
    agg = stream.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "10 minutes")).count()
    drain(agg, f"{base}/out", f"{base}/ck")
    # a row one hour behind the watermark arrives in the next run: it is dropped
    spark.createDataFrame([(3, TS(2024, 1, 1, 10, 5)), (4, TS(2024, 1, 1, 13, 0))], schema) \
        .write.parquet(f"{base}/in/b2")
    drain(agg, f"{base}/out", f"{base}/ck")
    starts = sorted(r["window"]["start"] for r in spark.read.parquet(f"{base}/out").collect())
    counts = {r["window"]["start"]: r["count"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert counts[starts[0]] == 1  # the 10:00 window kept only the on-time row


def test_layout_spec_and_statistics(spark):
    with pytest.raises(ValueError):
        lay.LayoutSpec(["a", "b", "c", "d", "e"])
    base = scratch_path(spark, "spec")
    lay.LayoutSpec(["a"]).save(spark, base)
    lay.LayoutSpec(["b", "a"]).save(spark, base)  # changing the spec rewrites no data
    assert lay.LayoutSpec.load(spark, base).cluster_by == ["b", "a"]
    spark.range(100).write.mode("overwrite").option("path", scratch_path(spark, "stats_probe")) \
        .saveAsTable("tp_stats_probe")
    spark.sql("ANALYZE TABLE tp_stats_probe COMPUTE STATISTICS FOR ALL COLUMNS")
    stats = spark.sql("DESCRIBE TABLE EXTENDED tp_stats_probe").filter("col_name = 'Statistics'").collect()
    assert stats and "100 rows" in stats[0]["data_type"]
    spark.sql("DROP TABLE tp_stats_probe")


# ---------------------------------------------------------------- segmented scan (hot keys)

@pytest.mark.parametrize("parts", [1, 5, 13])
def test_keyed_scan_matches_windows(spark, parts):
    from tidepool.operators.scan import keyed_running
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "41")
    try:
        base = spark.range(0, 2000).select(
            F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 5).cast("long").alias("k"),  # hot key 0
            (F.col("id") * 7919 % 53).cast("long").alias("v"),
            ((F.col("id") * 104729) % 50000).cast("long").alias("t"),
            (F.col("id") % 11 * 0.5).alias("x"))
        got = keyed_running(base, ["k"], [("v", "desc"), "t"], sums=[("x", "run_x")], row_number="rn", rank="rk",
                         dense_rank="drk", lags=[("t", "prev_t")], session=("t", 700, "sess"),
                         rank_by=1, num_partitions=parts)
        w = Window.partitionBy("k").orderBy(F.desc("v"), "t")
        wr = w.rowsBetween(Window.unboundedPreceding, 0)
        wv = Window.partitionBy("k").orderBy(F.desc("v"))
        prev = F.lag("t").over(w)
        want = (base.withColumn("run_x", F.sum("x").over(wr)).withColumn("rn", F.row_number().over(w))
                .withColumn("rk", F.rank().over(wv)).withColumn("drk", F.dense_rank().over(wv))
                .withColumn("prev_t", prev)
                .withColumn("_f", F.when(prev.isNull() | ((F.col("t") - prev) > 700), 1).otherwise(0))
                .withColumn("sess", F.sum("_f").over(wr)).drop("_f"))
        cols = ["k", "v", "t", "x", "run_x", "rn", "rk", "drk", "prev_t", "sess"]
        assert srt(got.select(*cols).collect()) == srt(want.select(*cols).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_running_with_nulls_and_large_numbers(spark):
    from tidepool.operators.scan import keyed_running
    big = 9007199254740993
    df = spark.createDataFrame([(1, 1, 10.0, big), (1, 2, None, None), (1, 3, 5.0, big + 2), (1, 4, 7.0, None), (None, 1, None, big), (None, 2, 1.0, 3)],
                               "k int, o int, v double, id long")
    got = keyed_running(df, ["k"], ["o"], sums=[("v", "s")], lags=[("id", "p")], num_partitions=4)
    assert srt(got.collect()) == srt([(1, 1, 10.0, big, 10.0, None), (1, 2, None, None, 10.0, big), (1, 3, 5.0, big + 2, 15.0, None),
                                      (1, 4, 7.0, None, 22.0, big + 2), (None, 1, None, big, None, None), (None, 2, 1.0, 3, 1.0, big)])


def test_snake_case_columns(spark):
    from tidepool.functions.naming import snake_case, snake_case_columns
    assert [snake_case(c) for c in ["customerId", "OrderDate", "totalAmountUSD", "ship to", "HTTPStatus"]] == \
        ["customer_id", "order_date", "total_amount_usd", "ship_to", "http_status"]
    df = spark.createDataFrame([("1", "2024-01-02")], "customerId string, signupDate string")
    assert snake_case_columns(df).columns == ["customer_id", "signup_date"]


def test_nest_has_a_fixed_grain(spark):
    from tidepool.functions.nested import explode_struct_array, nest
    for n in (10, 100_000):
        df = spark.range(0, n).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
        assert nest(df, ["k"], ["v"], "items").count() == 2
        parts = nest(df, ["k"], ["v"], "items", parts=4)
        assert parts.count() <= 8 and parts.groupBy("k").count().count() == 2
        back = explode_struct_array(parts, "items")
        assert back.count() == n and back.distinct().count() == n
    one = nest(spark.createDataFrame([(1, 3), (1, None), (1, 2)], "k int, v int"), ["k"], ["v"], "items").first()
    assert [x.v for x in one["items"]] == [None, 2, 3]


# ---------------------------------------------------------------- exercise expectations

def test_rank_ties_rank_vs_dense(spark):
    from tidepool.operators.scan import keyed_running
    df = spark.createDataFrame([("A", 5), ("B", 4), ("C", 4), ("D", 3), ("E", 2)], "c string, n long") \
        .withColumn("g", F.lit(1))
    for parts in (1, 3):
        out = {r["c"]: (r["rk"], r["drk"]) for r in keyed_running(
            df, ["g"], [("n", "desc"), "c"], rank="rk", dense_rank="drk", rank_by=1, num_partitions=parts).collect()}
        assert out == {"A": (1, 1), "B": (2, 2), "C": (2, 2), "D": (4, 3), "E": (5, 4)}


def test_ntile_two_per_quartile(spark):
    df = spark.createDataFrame([(f"C{i}", float(100 * i)) for i in range(1, 9)], "c string, spend double")
    out = global_ntile(df, 4, [F.col("spend").desc(), F.col("c")], "q")
    counts = {r["q"]: r["n"] for r in out.groupBy("q").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {1: 2, 2: 2, 3: 2, 4: 2}
    assert {r["c"] for r in out.filter("q = 1").collect()} == {"C8", "C7"}


def test_top2_per_customer(spark):
    from tidepool.operators.relational import top_n_per_group
    rows = [(f"CUST-{c}", f"ORD-{c}{i}", float(i * 10 + c)) for c in range(3) for i in range(4)]
    df = spark.createDataFrame(rows, "customer_id string, order_id string, amount double")
    out = top_n_per_group(df, ["customer_id"], [F.desc("amount"), F.asc("order_id")], 2)
    assert out.count() == 6
    assert {r["order_id"] for r in out.filter("customer_id = 'CUST-0'").collect()} == {"ORD-03", "ORD-02"}


def test_sessions_from_gaps(spark):
    base = TS(2024, 1, 1, 9, 0)
    mins = {"u1": [0, 10, 55, 115, 125, 160], "u2": [0, 20, 55]}  # u1 gaps 45, 60, 35 split; u2 gap 35 splits
    rows = [(f"{u}-{i}", u, base + dt.timedelta(minutes=m)) for u, ms in mins.items() for i, m in enumerate(ms)]
    ev = spark.createDataFrame(rows, "event_id string, user_id string, ts timestamp")
    out = sessionize(ev, "user_id", "ts", "event_id", 30)
    n = {r["user_id"]: r["s"] for r in out.groupBy("user_id").agg(F.max("session_num").alias("s")).collect()}
    assert n == {"u1": 4, "u2": 2}


def test_not_matched_by_source_update(spark):
    t = orders(spark, [("A", 1.0, "open", TS(2024, 1, 1)), ("B", 2.0, "open", TS(2024, 1, 1))])
    s = orders(spark, [("A", 5.0, "open", TS(2024, 1, 2))])
    out = as_dict(MergeBuilder(t, s, ["order_id"]).whenMatchedUpdateAll()
                  .whenNotMatchedBySourceUpdate({"status": F.lit("stale")}).execute())
    assert out["A"]["amount"] == 5.0 and out["A"]["status"] == "open"
    assert out["B"]["status"] == "stale" and out["B"]["amount"] == 2.0


def test_copy_into_recovers_after_crash_between_data_and_ledger(spark):
    from tidepool.sources import files as fs
    base = scratch_path(spark, "copy_crash")
    schema = spark.createDataFrame([], "id long").schema
    spark.range(0, 10).repartition(2).write.json(f"{base}/landing/a")
    assert fs.copy_into(spark, f"{base}/landing", "json", schema, f"{base}/t", f"{base}/ledger") == 2
    # simulate a crash after step 2 of a new batch: files marked pending, data half written
    spark.range(10, 16).repartition(1).write.json(f"{base}/landing/b")
    new = [r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
           .load(f"{base}/landing/b").select("path").collect()]
    fs._ledger_append(spark, f"{base}/ledger", [(f, "crashed", "pending") for f in new])
    spark.range(10, 13).withColumn("_source_file", F.lit("x")).withColumn("_load_batch", F.lit("crashed")) \
        .write.mode("append").partitionBy("_load_batch").parquet(f"{base}/t")
    assert fs.copy_into(spark, f"{base}/landing", "json", schema, f"{base}/t", f"{base}/ledger") == 0
    assert fs.copy_into(spark, f"{base}/landing", "json", schema, f"{base}/t", f"{base}/ledger") == 0
    ids = sorted(r["id"] for r in fs.read_loaded(spark, f"{base}/t").collect())
    assert ids == list(range(16))


def test_merge_into_buckets_rewrites_only_touched_buckets(spark):
    from tidepool.operators import layout as lay
    from tidepool.operators.merge import merge_into_buckets, write_bucketed
    base = scratch_path(spark, "bucket_merge")
    t = spark.range(0, 200).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    write_bucketed(t, f"{base}/t", ["k"], 8)
    before = {r["path"]: r["modificationTime"] for r in lay.list_files(spark, f"{base}/t").collect()}
    s = spark.createDataFrame([(5, 9.0), (500, 2.0)], "k long, v double")
    touched = merge_into_buckets(spark, f"{base}/t", s, ["k"], [WhenMatched(update="*"), WhenNotMatched()],
                                 8, f"{base}/stage")
    out = {r["k"]: r["v"] for r in spark.read.parquet(f"{base}/t").collect()}
    assert len(out) == 201 and out[5] == 9.0 and out[500] == 2.0 and out[6] == 1.0
    after = {r["path"]: r["modificationTime"] for r in lay.list_files(spark, f"{base}/t").collect()}
    untouched = [p for p in before if not any(f"_bucket={b}/" in p for b in touched)]
    assert untouched and all(after.get(p) == before[p] for p in untouched)


def test_schema_evolution_modes(spark):
    from pyspark.sql.types import StructType
    from tidepool.sources.files import merge_schemas
    saved = StructType.fromDDL("id BIGINT, amount DOUBLE")
    new = StructType.fromDDL("id BIGINT, amount DOUBLE, priority STRING")
    assert merge_schemas(saved, new, "addNewColumns").fieldNames() == ["id", "amount", "priority"]
    assert merge_schemas(saved, new, "rescue") == saved
    with pytest.raises(ValueError):
        merge_schemas(saved, new, "failOnNewColumns")
    assert merge_schemas(None, new) == new


def test_replace_where_predicate_form(spark):
    from tidepool.sources.sinks import replace_where
    old = spark.createDataFrame([(1, "cancelled", 1.0), (2, "completed", 2.0), (3, None, 3.0)],
                                "id int, status string, amount double")
    new = spark.createDataFrame([(2, "completed", 20.0), (4, "completed", 40.0), (5, "cancelled", 50.0)],
                                "id int, status string, amount double")
    out = {r["id"]: r["amount"] for r in replace_where(old, new, F.col("status") == "completed").collect()}
    # completed rows come from the new batch; the rest of the old rows (incl. NULL status) stay
    assert out == {1: 1.0, 3: 3.0, 2: 20.0, 4: 40.0}


@pytest.mark.parametrize("trigger", ["once", "1 second"])
def test_other_triggers_drain_everything(spark, trigger):
    from tidepool.streaming.runner import drain
    base = scratch_path(spark, "triggers")
    spark.range(0, 50).repartition(3).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").parquet(f"{base}/in")
    drain(stream, f"{base}/out", f"{base}/ck", trigger=trigger)
    assert spark.read.parquet(f"{base}/out").count() == 50


def test_quality_report_pass_rates(spark):
    # 12 bronze rows (9 with a customer, 10 with a positive amount), 10 silver rows
    # (6 with a region), 8 gold rows (6 and 7 valid): the expected rates of the exercise
    bronze = spark.createDataFrame([(i, None if i < 3 else f"C{i}", 0.0 if i in (0, 5) else 10.0) for i in range(12)],
                                   "id int, customer string, amount double")
    silver = spark.createDataFrame([(i, None if i < 4 else "EU") for i in range(10)], "id int, region string")
    gold = spark.createDataFrame([(i, -1.0 if i < 2 else 5.0, None if i == 0 else i) for i in range(8)],
                                 "day int, revenue double, n int")
    rep = q.quality_report({
        "bronze": (bronze, {"has_customer": "customer IS NOT NULL", "positive_amount": "amount > 0"}),
        "silver": (silver, {"has_region": "region IS NOT NULL", "has_id": "id IS NOT NULL AND id < 10 AND id > 1"}),
        "gold": (gold, {"positive_revenue": "revenue > 0", "has_count": "n IS NOT NULL"}),
    })
    rates = {(r["table_name"], r["check_name"]): r["pass_rate"] for r in rep.collect()}
    assert rates == {("bronze", "has_customer"): 0.75, ("bronze", "positive_amount"): 0.8333,
                     ("silver", "has_region"): 0.6, ("silver", "has_id"): 0.8,
                     ("gold", "positive_revenue"): 0.75, ("gold", "has_count"): 0.875}


def test_silver_incremental_merge_fixture(spark):
    silver = orders(spark, [(f"ORD-{i}", 10.0 * i, "pending", TS(2024, 1, 10)) for i in range(1, 7)])
    bronze = orders(spark, [
        ("ORD-1", 11.0, "shipped", TS(2024, 1, 11)), ("ORD-1", 12.0, "shipped", TS(2024, 1, 12)),
        ("ORD-1", 13.0, "delivered", TS(2024, 1, 13)),                  # one id three times: newest wins
        ("ORD-2", 99.0, "cancelled", TS(2024, 1, 9)),                   # older than silver: ignored
        ("ORD-3", 31.0, "shipped", TS(2024, 1, 11)),
        ("ORD-7", 70.0, "pending", TS(2024, 1, 11)), ("ORD-8", 80.0, "pending", TS(2024, 1, 11)),
        ("ORD-9", 90.0, "pending", TS(2024, 1, 11))])
    latest = latest_per_key(bronze, ["order_id"], ["updated_at"])
    out = as_dict(merge(silver, latest, ["order_id"],
                        [WhenMatched("s.updated_at > t.updated_at", update="*"), WhenNotMatched()]))
    assert len(out) == 9
    assert (out["ORD-1"]["amount"], out["ORD-1"]["status"]) == (13.0, "delivered")
    assert (out["ORD-2"]["amount"], out["ORD-2"]["status"]) == (20.0, "pending")
    assert out["ORD-3"]["amount"] == 31.0 and out["ORD-9"]["amount"] == 90.0


def test_gold_incremental_merge_fixture(spark):
    gold = spark.createDataFrame([(dt.date(2024, 1, d), "EU", 1, 1.0) for d in range(1, 6)],
                                 "day date, region string, n_orders long, revenue double")
    silver = spark.createDataFrame(
        [(dt.date(2024, 1, 1 + i % 8), "EU", 10.0 + i) for i in range(12)], "day date, region string, amount double")
    daily = silver.groupBy("day", "region").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("amount").alias("revenue"))
    out = merge(gold, daily, ["day", "region"],
                [WhenMatched(update={"n_orders": "s.n_orders", "revenue": "s.revenue"}), WhenNotMatched()])
    rows = {r["day"].day: (r["n_orders"], r["revenue"]) for r in out.collect()}
    assert len(rows) == 8                                      # 5 replaced + 3 inserted
    assert rows[1] == (2, 10.0 + 18.0) and rows[8] == (1, 17.0)
