"""Sources, sinks and ingestion (survey 2.1).

Each query lands data derived from the test tables in a fresh scratch folder
(under the session's checkpoint dir), reads it back through the operator and
returns the result; the value checked is the data read back.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
                               TimestampNTZType)

from ..functions.naming import snake_case_columns
from ..functions.numeric import rnd
from ..operators.merge import WhenMatched, WhenNotMatched, merge_into_buckets, write_bucketed
from ..operators.relational import latest_per_key
from ..session import scratch_path
from ..sources import files as fs
from ..sources.rescue import drift_counts, read_rescued
from ..sources.sinks import replace_where as predicate_overwrite
from ..sources.sinks import write_partitioned
from ..sources.tables import Tables
from ..streaming.runner import drain
from .merges import merge_source, merge_target
from .registry import register

# JSON keeps event times to the microsecond (the writer's default drops to milliseconds).
TS_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType())])


@register("csv_roundtrip", ops=("SRC1", "SRC4", "SNK10", "SNK2"), oracle="SELECT * FROM part")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Pipe-separated CSV with header in several files, read back with type inference."""
    part = Tables(spark, sf).part
    path = scratch_path(spark, "csv_roundtrip")
    fs.write_files(part, path, "csv", 3, header=True, sep="|")
    back = fs.read_csv(spark, path, sep="|", header=True, infer=True)
    return fs.unify([(back, {})], part.schema)


@register("json_explicit_schema", ops=("SRC2",), oracle="SELECT * FROM orders")
def json_explicit_schema(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    path = scratch_path(spark, "json_explicit")
    fs.write_files(o, path, "json", 4)
    return fs.read_json(spark, path, schema=o.schema)


@register("json_nested_flatten", ops=("SRC3", "STR1"), oracle="""
SELECT o.o_orderkey, o.o_totalprice, c.c_custkey AS customer_custkey, c.c_name AS customer_name,
       n.n_name AS customer_nation_name, n.n_regionkey AS customer_nation_regionkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def json_nested_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON (struct in struct) read with inference and flattened by dot paths."""
    t = Tables(spark, sf)
    nested = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
              .select("o_orderkey", "o_totalprice",
                      F.struct(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"),
                               F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("regionkey"))
                               .alias("nation")).alias("customer")))
    path = scratch_path(spark, "json_nested")
    fs.write_files(nested, path, "json", 4)
    back = fs.read_json(spark, path)
    return back.select("o_orderkey", "o_totalprice",
                       F.col("customer.custkey").alias("customer_custkey"),
                       F.col("customer.name").alias("customer_name"),
                       F.col("customer.nation.name").alias("customer_nation_name"),
                       F.col("customer.nation.regionkey").cast("int").alias("customer_nation_regionkey"))


@register("csv_permissive_split", ops=("SRC5",), oracle="""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_discount END AS l_discount,
  l_returnflag = 'R' AS is_corrupt
FROM lineitem
""")
def csv_permissive_split(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines carry a non-numeric quantity (malformed); 'A' lines an empty
    discount (a valid NULL reading). Good and bad rows come back tagged."""
    li = Tables(spark, sf).lineitem
    raw = li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                    F.col("l_linenumber").cast("string").alias("l_linenumber"),
                    F.when(F.col("l_returnflag") == "R", F.lit("bad")).otherwise(F.col("l_quantity").cast("string"))
                    .alias("l_quantity"),
                    F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(F.col("l_discount").cast("string"))
                    .alias("l_discount"))
    path = scratch_path(spark, "csv_permissive")
    fs.write_files(raw, path, "csv", 3, header=True)
    schema = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
                         StructField("l_quantity", DoubleType()), StructField("l_discount", DoubleType())])
    good, bad = fs.read_csv_permissive(spark, path, schema)
    return good.withColumn("is_corrupt", F.lit(False)).unionByName(
        bad.drop(fs.CORRUPT).withColumn("is_corrupt", F.lit(True)))


@register("multi_format_union", ops=("SRC6", "SET4", "PRJ2"), oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders
""")
def multi_format_union(spark: SparkSession, sf: str) -> DataFrame:
    """One entity from three systems: CSV, JSON and Parquet with different column names."""
    o = Tables(spark, sf).orders
    base = scratch_path(spark, "multi_format")
    a = o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("CustomerKey"),
        F.col("o_orderstatus").alias("Status"), F.col("o_totalprice").alias("Amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("OrderDate"))
    b = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("state"), F.col("o_totalprice").cast("string").alias("total"),
        F.to_date("o_orderdate").alias("day"))
    c = o.filter(~F.col("o_orderstatus").isin("F", "O")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("order_date"))
    fs.write_files(a, f"{base}/csv", "csv", 2, header=True)
    fs.write_files(b, f"{base}/json", "json", 2)
    fs.write_files(c, f"{base}/parquet", "parquet", 2)
    target = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
                         StructField("order_date", DateType())])
    return fs.unify([
        (snake_case_columns(fs.read_csv(spark, f"{base}/csv", header=True, infer=True)),
         {"order_key": "o_orderkey", "customer_key": "o_custkey", "status": "o_orderstatus",
          "amount": "o_totalprice"}),
        (fs.read_json(spark, f"{base}/json"),
         {"order_id": "o_orderkey", "customer_id": "o_custkey", "state": "o_orderstatus", "total": "o_totalprice",
          "day": "order_date"}),
        (spark.read.parquet(f"{base}/parquet"), {}),
    ], target)


@register("copy_into_idempotent", ops=("SRC7",), oracle="SELECT * FROM orders")
def copy_into_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, four loads: reruns add nothing, the second landing is loaded once."""
    o = Tables(spark, sf).orders
    base = scratch_path(spark, "copy_into")
    landing, target, ledger = f"{base}/landing", f"{base}/target", f"{base}/ledger"
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    fs.write_files(o.filter(F.col("o_orderdate") < cut), f"{landing}/batch1", "json", 3)
    loads = [fs.copy_into(spark, landing, "json", o.schema, target, ledger, {"recursiveFileLookup": "true"})]
    loads.append(fs.copy_into(spark, landing, "json", o.schema, target, ledger, {"recursiveFileLookup": "true"}))
    fs.write_files(o.filter(F.col("o_orderdate") >= cut), f"{landing}/batch2", "json", 2)
    loads.append(fs.copy_into(spark, landing, "json", o.schema, target, ledger, {"recursiveFileLookup": "true"}))
    loads.append(fs.copy_into(spark, landing, "json", o.schema, target, ledger, {"recursiveFileLookup": "true"}))
    if loads[1] != 0 or loads[3] != 0:
        raise AssertionError(f"incremental load is not idempotent: {loads}")
    return fs.read_loaded(spark, target)


@register("copy_into_schema_merge", ops=("SRC8",), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def copy_into_schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The second landing (gzipped, another suffix) brings a new column; rows loaded before have NULL in it."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    base = scratch_path(spark, "copy_merge")
    landing, target, ledger = f"{base}/landing", f"{base}/target", f"{base}/ledger"
    even = F.coalesce(F.col("o_orderkey") % 2 == 0, F.lit(False))
    fs.write_files(o.filter(~even).drop("o_orderpriority"), f"{landing}/b1", "json", 2)
    fs.copy_into(spark, landing, "json", None, target, ledger, {"recursiveFileLookup": "true"})
    fs.write_files(o.filter(even), f"{landing}/b2", "json", 2, compression="gzip")
    fs.copy_into(spark, landing, "json", None, target, ledger, {"recursiveFileLookup": "true"})
    return fs.read_loaded(spark, target).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@register("bronze_metadata", ops=("SRC18", "SRC19"), oracle="""
SELECT event_id, user_id, event_type, ts, 'events_feed' AS _source_system, true AS from_landing FROM events
""")
def bronze_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze columns: source file, ingest time, source name; event time parsed from text."""
    ev = Tables(spark, sf).events
    path = scratch_path(spark, "bronze")
    text_ts = ev.select("event_id", "user_id", "event_type",
                        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_text"))
    fs.write_files(text_ts, path, "json", 3)
    raw = fs.read_json(spark, path, schema="event_id BIGINT, user_id BIGINT, event_type STRING, ts_text STRING")
    bronze = fs.with_source_metadata(raw, "events_feed")
    return bronze.select("event_id", "user_id", "event_type",
                         F.try_to_timestamp("ts_text", F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
                         .alias("ts"),
                         "_source_system", F.col("_source_file").contains(path.rstrip("/").rsplit("/", 1)[-1]).alias("from_landing"))


@register("schema_hints", ops=("SRC10", "SRC11"), oracle="""
SELECT event_id, user_id, event_type, CAST(floor(value) AS DOUBLE) AS value FROM events
""")
def schema_hints(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts land as whole numbers (inferred BIGINT); the hint makes them DOUBLE in the stream."""
    ev = Tables(spark, sf).events
    base = scratch_path(spark, "schema_hints")
    fs.write_files(ev.select("event_id", "user_id", "event_type", F.floor("value").alias("value")),
                   f"{base}/landing", "json", 3)
    as_text = fs.read_json(spark, f"{base}/landing", primitives_as_string=True)   # inference switched off
    if as_text.schema["value"].dataType.simpleString() != "string":
        raise AssertionError("primitivesAsString should read every value as text")
    schema = fs.infer_with_hints(spark, f"{base}/landing", "json", "value DOUBLE", sampling_ratio=1.0)
    stream = spark.readStream.schema(schema).json(f"{base}/landing")
    drain(stream, f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type", "value")


@register("stream_file_ingest", ops=("SRC9", "SNK8", "SNK12", "STM11", "STM12"), oracle="""
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def stream_file_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """JSON landing drained file by file into a parquet table; a rerun on the
    same checkpoint processes nothing."""
    ev = Tables(spark, sf).events
    base = scratch_path(spark, "stream_ingest")
    fs.write_files(ev, f"{base}/landing", "json", 4, timestampNTZFormat=TS_MICROS)
    stream = (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("timestampNTZFormat", TS_MICROS).json(f"{base}/landing"))
    drain(stream, f"{base}/out", f"{base}/_checkpoint")
    again = spark.readStream.schema(EVENT_SCHEMA).option("timestampNTZFormat", TS_MICROS).json(f"{base}/landing")
    q = drain(again, f"{base}/out", f"{base}/_checkpoint")
    rerun_rows = sum(p.get("numInputRows", 0) for p in q.recentProgress)
    if rerun_rows:
        raise AssertionError(f"rerun on the same checkpoint read {rerun_rows} rows")
    return spark.read.parquet(f"{base}/out")


@register("stream_schema_evolution", ops=("SRC12", "SRC13"), oracle="""
SELECT event_id, user_id, event_type, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN NULL ELSE props END AS props
FROM events
""")
def stream_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A later landing adds ``props``; the next run merges the schema, earlier rows read NULL."""
    ev = Tables(spark, sf).events
    base = scratch_path(spark, "stream_evolve")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    fs.write_files(ev.filter(F.col("ts") < cut).select("event_id", "user_id", "event_type"),
                   f"{base}/landing/b1", "json", 2)
    s1 = fs.infer_with_hints(spark, f"{base}/landing", "json", "event_id BIGINT", recursiveFileLookup="true")
    drain(spark.readStream.schema(s1).option("recursiveFileLookup", "true").json(f"{base}/landing"),
          f"{base}/out", f"{base}/_checkpoint")
    fs.write_files(ev.filter(F.col("ts") >= cut).select("event_id", "user_id", "event_type", "props"),
                   f"{base}/landing/b2", "json", 2)
    inferred = fs.infer_with_hints(spark, f"{base}/landing", "json", "event_id BIGINT", recursiveFileLookup="true")
    s2 = fs.merge_schemas(s1, inferred, mode="addNewColumns")
    drain(spark.readStream.schema(s2).option("recursiveFileLookup", "true").json(f"{base}/landing"),
          f"{base}/out", f"{base}/_checkpoint")
    return spark.read.option("mergeSchema", "true").parquet(f"{base}/out") \
                .select("event_id", "user_id", "event_type", "props")


@register("rescued_data", ops=("SRC14", "SRC15"), oracle="""
SELECT event_id, user_id, event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'error' THEN '{"value":"n/a"}'
       WHEN event_type = 'signup' THEN '{"channel":"' || CAST(user_id % 3 AS VARCHAR) || '"}' END AS _rescued_data
FROM events
""")
def rescued_data(spark: SparkSession, sf: str) -> DataFrame:
    """Error events carry value "n/a" (type misfit), signups an unknown field:
    both land in ``_rescued_data`` while the typed columns stay clean."""
    ev = Tables(spark, sf).events
    path = scratch_path(spark, "rescued")
    good = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    misfit = F.to_json(F.struct("event_id", "user_id", "event_type", F.lit("n/a").alias("value")))
    extra = F.to_json(F.struct("event_id", "user_id", "event_type", "value",
                               (F.col("user_id") % 3).cast("string").alias("channel")))
    line = (F.when(F.col("event_type") == "error", misfit).when(F.col("event_type") == "signup", extra)
            .otherwise(good))
    ev.select(line.alias("value")).repartition(3).write.mode("overwrite").text(path)
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("event_type", StringType()), StructField("value", DoubleType())])
    return fs.parse_with_rescue(spark.read.text(path), schema)


def nested_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON lines of which some do not fit: by event_id, a text for user.id (every 5th), an object among
    the tags (every 7th), a text among the attributes (every 11th), an unknown field at depth two (every 13th) and one at the
    top (every 17th), a number for the whole user (every 19th), a broken line (every 23rd)."""
    ev = Tables(spark, sf).events
    eid = F.col("event_id")
    user = F.concat(F.lit('{"id":'), F.when(eid % 5 == 0, F.lit('"n/a"')).otherwise(F.col("user_id").cast("string")), F.lit(',"type":"'),
                    F.col("event_type"), F.lit('"'), F.when(eid % 13 == 0, F.lit(',"channel":{"c":1}')).otherwise(F.lit("")), F.lit("}"))
    user = F.when(eid % 19 == 0, F.lit("7")).otherwise(user)
    tags = F.when(eid % 7 == 0, F.lit('[1,{"x":2},3]')).otherwise(F.lit("[1,2]"))
    attrs = F.when(eid % 11 == 0, F.lit('{"w":1.5,"h":"tall"}')).otherwise(F.lit('{"w":1.5}'))
    line = F.concat(F.lit('{"event_id":'), eid.cast("string"), F.lit(',"user":'), user, F.lit(',"tags":'), tags, F.lit(',"attrs":'), attrs,
                    F.when(eid % 17 == 0, F.concat(F.lit(',"batch":{"n":'), (eid % 3).cast("string"), F.lit("}"))).otherwise(F.lit("")), F.lit("}"))
    path = scratch_path(spark, "nested-lines")
    ev.select(F.when(eid % 23 == 0, F.lit("{broken")).otherwise(line).alias("value")).write.text(path)
    return spark.read.text(path)


NESTED_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("user", StructType([StructField("id", LongType()), StructField("type", StringType())])),
    StructField("tags", ArrayType(IntegerType())), StructField("attrs", MapType(StringType(), DoubleType()))])
MISFITS_SQL = """m AS (
  SELECT event_id, user_id, event_type, event_id % 23 = 0 AS broken, event_id % 19 = 0 AS no_user,
    list_filter([
      CASE WHEN event_id % 19 = 0 THEN '"$.user":7' WHEN event_id % 5 = 0 THEN '"$.user.id":"n/a"' END,
      CASE WHEN event_id % 19 <> 0 AND event_id % 13 = 0 THEN '"$.user.channel":{"c":1}' END,
      CASE WHEN event_id % 7 = 0 THEN '"$.tags[1]":{"x":2}' END,
      CASE WHEN event_id % 11 = 0 THEN '"$.attrs.h":"tall"' END], lambda x: x IS NOT NULL) AS misfits,
    CASE WHEN event_id % 17 = 0 THEN '"$.batch":{"n":' || (event_id % 3) || '}' END AS new_field
  FROM events)"""
NESTED_COLUMNS_SQL = """CASE WHEN NOT broken THEN event_id END AS event_id,
       CASE WHEN NOT broken AND NOT no_user AND event_id % 5 <> 0 THEN user_id END AS user_id,
       CASE WHEN NOT broken AND NOT no_user THEN event_type END AS user_type,
       CASE WHEN broken THEN NULL WHEN event_id % 7 = 0 THEN 4 ELSE 3 END AS tag_sum,
       CASE WHEN broken THEN NULL WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS n_attrs,
       CASE WHEN NOT broken THEN 1.5 END AS w"""


def _nested_columns(df: DataFrame, *more) -> DataFrame:
    total = F.aggregate("tags", F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return df.select("event_id", F.col("user.id").alias("user_id"), F.col("user.type").alias("user_type"), total.alias("tag_sum"),
                     F.when(F.col("attrs").isNotNull(), F.size("attrs")).alias("n_attrs"), F.col("attrs")["w"].alias("w"), *more)


@register("rescue_nested", ops=("SRC13", "SRC14"), oracle=f"""WITH {MISFITS_SQL}
SELECT {NESTED_COLUMNS_SQL},
       CASE WHEN broken THEN '{{"_corrupt":"{{broken"}}'
            WHEN len(misfits) > 0 OR new_field IS NOT NULL THEN '{{' || array_to_string(list_concat(misfits, CASE WHEN new_field IS NULL THEN []::VARCHAR[] ELSE [new_field] END), ',') || '}}'
       END AS _rescued_data
FROM m
""")
def rescue_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Struct, array and map fields: what fits is typed, what does not is rescued with its path."""
    return _nested_columns(read_rescued(nested_lines(spark, sf), NESTED_SCHEMA), fs.RESCUED)


@register("rescue_new_columns", ops=("SRC13",), oracle=f"""WITH {MISFITS_SQL}
SELECT {NESTED_COLUMNS_SQL}, CASE WHEN NOT broken AND new_field IS NOT NULL THEN event_id % 3 END AS batch_n,
       CASE WHEN broken THEN '{{"_corrupt":"{{broken"}}' WHEN len(misfits) > 0 THEN '{{' || array_to_string(misfits, ',') || '}}' END AS _rescued_data
FROM m
""")
def rescue_new_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Mode addNewColumns: the unknown top-level field becomes a struct column of the type that its values have."""
    return _nested_columns(read_rescued(nested_lines(spark, sf), NESTED_SCHEMA, "addNewColumns"), F.col("batch.n").alias("batch_n"), fs.RESCUED)


@register("rescue_drift", ops=("SRC15",), oracle=f"""WITH {MISFITS_SQL},
p AS (SELECT CASE WHEN broken THEN ['_corrupt'] ELSE list_transform(list_concat(misfits, CASE WHEN new_field IS NULL THEN []::VARCHAR[] ELSE [new_field] END),
        lambda x: replace(split_part(x, '"', 2), '[1]', '[*]')) END AS paths FROM m)
SELECT path, count(*) AS n_values, count(*) AS n_rows FROM (SELECT unnest(paths) AS path FROM p) GROUP BY path
""")
def rescue_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The drift monitor: values and rows rescued for each field."""
    return drift_counts(read_rescued(nested_lines(spark, sf), NESTED_SCHEMA))


ORDER_STREAM_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType())])


@register("stream_csv", ops=("SRC16",), oracle="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def stream_csv(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    base = scratch_path(spark, "stream_csv")
    fs.write_files(o, f"{base}/landing", "csv", 3, header=True, sep="|")
    stream = (spark.readStream.option("sep", "|").option("header", True).schema(ORDER_STREAM_SCHEMA)
              .csv(f"{base}/landing"))
    drain(stream, f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out")


@register("stream_static_enrich", ops=("SRC17", "JOI11", "PRJ11", "STM14"), oracle="""
SELECT e.event_id, e.user_id, coalesce(c.c_mktsegment, 'UNKNOWN') AS segment,
       (e.value > 25) <> (c.c_acctbal > 0) AS value_balance_mismatch
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def stream_static_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Stream read from a table, left-joined to a static dimension."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "stream_enrich")
    name = "tp_events_" + os.path.basename(base).replace("-", "_")
    t.events.write.format("parquet").option("path", f"{base}/table").saveAsTable(name)
    stream = spark.readStream.table(name)
    dim = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    enriched = stream.join(dim, F.col("user_id") == F.col("c_custkey"), "left").select(
        "event_id", "user_id", F.coalesce("c_mktsegment", F.lit("UNKNOWN")).alias("segment"),
        ((F.col("value") > 25) != (F.col("c_acctbal") > 0)).alias("value_balance_mismatch"))
    try:
        drain(enriched, f"{base}/out", f"{base}/_checkpoint")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(f"{base}/out")


@register("partition_pruning", ops=("SNK5", "SNK7", "LAY1"), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
""")
def partition_pruning(spark: SparkSession, sf: str) -> DataFrame:
    """Written partitioned by status; the filter reads only the F folder."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = scratch_path(spark, "partitioned")
    write_partitioned(o, path, ["o_orderstatus"], max_records_per_file=5000)
    return spark.read.parquet(path).filter(F.col("o_orderstatus") == "F") \
                .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


@register("replace_where", ops=("SNK6",), oracle="""
SELECT o_orderkey, o_custkey,
  CASE WHEN year(o_orderdate) = 1999 THEN round(o_totalprice * 1.1, 2) ELSE o_totalprice END AS o_totalprice,
  CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders
""")
def replace_where(spark: SparkSession, sf: str) -> DataFrame:
    """Replace only the 1999 rows with restated prices; other years are kept. The new
    version is written to a new path."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice",
                                        F.year("o_orderdate").alias("o_year"))
    path = scratch_path(spark, "replace_where")
    write_partitioned(o, path, ["o_year"])
    restated = spark.read.parquet(path).filter(F.col("o_year") == 1999) \
                    .withColumn("o_totalprice", rnd(F.col("o_totalprice") * 1.1, 2))
    restated = restated.select("o_orderkey", "o_custkey", "o_totalprice", "o_year")
    version = scratch_path(spark, "replace_where_v2")
    old = spark.read.parquet(path).select(*restated.columns)
    write_partitioned(predicate_overwrite(old, restated, F.col("o_year") == 1999), version, ["o_year"])
    return spark.read.parquet(version).select("o_orderkey", "o_custkey", "o_totalprice", "o_year")


@register("stream_merge_upsert", ops=("SNK9", "MRG13"), oracle="""
WITH tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderdate AS updated_at
             FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
src AS (SELECT o_orderkey, o_custkey,
    CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'P' ELSE 'F' END AS o_orderstatus,
    round(o_totalprice * 1.1, 2) AS o_totalprice, o_orderdate,
    o_orderdate + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN INTERVAL 1 DAY
                       ELSE INTERVAL '-1' DAY END AS updated_at
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT * FROM src
UNION ALL
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
""")
def stream_merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """foreachBatch upsert: each micro-batch is deduplicated and merged into a
    bucket-partitioned table, rewriting only the buckets it touches (a replayed
    batch applies the same upsert again, which changes nothing)."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "stream_upsert")
    table = f"{base}/table"
    write_bucketed(merge_target(t), table, ["o_orderkey"], UPSERT_BUCKETS)
    src = merge_source(t)
    fs.write_files(src, f"{base}/landing", "parquet", 3)

    def upsert(batch: DataFrame, batch_id: int):
        latest = latest_per_key(batch, ["o_orderkey"], ["updated_at"])
        merge_into_buckets(spark, table, latest, ["o_orderkey"], [WhenMatched(update="*"), WhenNotMatched()],
                           UPSERT_BUCKETS, f"{base}/staging/batch={batch_id}")

    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", fs.files_a_trigger(spark, f"{base}/landing", 3)).parquet(f"{base}/landing")
    drain(stream, None, f"{base}/_checkpoint", foreach_batch=upsert)
    return spark.read.parquet(table).drop("_bucket")


UPSERT_BUCKETS = 16


@register("stream_fresh_dimension", ops=("STM14", "JOI11"), oracle="""
SELECT e.event_id, e.user_id,
  CASE WHEN e.ts < TIMESTAMP '2024-01-15' AND c.c_acctbal > 9000 THEN 'UNKNOWN'
       ELSE coalesce(c.c_mktsegment, 'UNKNOWN') END AS segment
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def stream_fresh_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension grows between micro-batches; ``foreachBatch`` re-reads it
    each time, so the second batch sees customers the first one did not
    (a static DataFrame built once keeps its original file listing)."""
    t = Tables(spark, sf)
    base = scratch_path(spark, "stream_fresh_dim")
    dim_path = f"{base}/dim"
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    c = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    c.filter(F.col("c_acctbal") <= 9000).write.parquet(dim_path)          # known before batch 1
    ev = t.events.select("event_id", "user_id", "ts")
    fs.write_files(ev.filter(F.col("ts") < cut), f"{base}/landing/b1", "parquet", 2)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        dim = spark.read.parquet(dim_path).select("c_custkey", "c_mktsegment")   # fresh per batch
        (batch.join(dim, F.col("user_id") == F.col("c_custkey"), "left")
         .select("event_id", "user_id", F.coalesce("c_mktsegment", F.lit("UNKNOWN")).alias("segment"))
         .write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}"))  # idempotent per batch id

    def run():
        stream = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true")
                  .parquet(f"{base}/landing"))
        drain(stream, None, f"{base}/_checkpoint", foreach_batch=enrich)

    run()
    c.filter(F.col("c_acctbal") > 9000).write.mode("append").parquet(dim_path)   # new customers arrive
    fs.write_files(ev.filter(F.col("ts") >= cut), f"{base}/landing/b2", "parquet", 2)
    run()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", "segment")
