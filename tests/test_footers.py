"""Reports from Parquet footers."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tidepool.operators import footers as ft
from tidepool.session import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "footer_test")
    df = spark.range(4000).select(
        "id", F.expr("CASE WHEN id % 10 = 0 THEN NULL ELSE concat('t', lpad(CAST(id AS STRING), 5, '0')) END").alias("t"),
        F.expr("date_add(date'2024-01-01', CAST(id DIV 100 AS INT))").alias("d"),
        F.expr("timestamp_micros(id * 1000000)").cast("timestamp_ntz").alias("ts"),
        F.expr("CAST(id AS DECIMAL(12,2))").alias("m"), F.expr("CASE WHEN id < 1000 THEN id END").alias("low"),
        F.expr("named_struct('x', id)").alias("s"), F.expr("map('k', id)").alias("mp"))
    df.repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    return path


def test_ranges_equal_the_rows(spark, table):
    got = ft.footer_stats(spark, table, ["id", "t", "s.x", "low", "absent"])
    ids = got.filter("column = 'id'").agg(F.sum("rows"), F.min(F.col("min").cast("long")), F.max(F.col("max").cast("long")),
                                         F.sum("nulls")).first()
    assert tuple(ids) == (4000, 0, 3999, 0)
    assert got.filter("column = 't'").agg(F.sum("nulls")).first()[0] == 400
    assert got.filter("column = 's.x'").agg(F.max(F.col("max").cast("long"))).first()[0] == 3999
    assert got.filter("column = 'absent' AND (min IS NOT NULL OR nulls IS NOT NULL)").count() == 0


@pytest.mark.parametrize("probe", [
    {"id": 1234}, {"t": "t01234"}, {"d": dt.date(2024, 1, 13)}, {"ts": dt.datetime(1970, 1, 1, 0, 20, 34)},
    {"id": 1234, "t": "t01234"}, {"m": 1234}, {"low": 7}, {"s.x": 1234}])
def test_a_point_filter_reads_the_files_that_may_match(spark, table, probe):
    row = ft.footer_report(spark, table, probe).first()
    assert (row.total_files, row.total_rows) == (4, 4000)
    assert 1 <= row.files_to_read <= 2


def test_nulls_and_values_without_a_range_are_kept(spark, table):
    assert ft.footer_report(spark, table, {"low": None}).first().files_to_read == 3
    assert ft.footer_report(spark, table, {"id": None}).first().files_to_read == 0
    assert ft.footer_report(spark, table, {"absent": 1}).first().files_to_read == 4
    assert ft.footer_report(spark, table, {"id": "no number"}).first().files_to_read == 4
    assert ft.footer_report(spark, table, {"id": 5000}).first().files_to_read == 0


def test_no_data_page_is_read(spark, table):
    """With all pages overwritten the reports stay as they were."""
    import pyarrow.parquet as pq
    want = ft.footer_stats(spark, table, ["id", "t"], {"id": 77}).drop("path").collect()
    spoiled = scratch_path(spark, "spoiled")
    spark.read.parquet(table).write.parquet(spoiled)
    local = spoiled.removeprefix("file:")
    for f in glob.glob(f"{local}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        end = max(meta.row_group(0).column(i).data_page_offset + 1 for i in range(meta.num_columns))
        with open(f, "r+b") as out:
            out.seek(4)
            out.write(b"\0" * (end - 4))
    for f in glob.glob(f"{local}/.*.crc"):
        open(f, "wb").close()
    got = ft.footer_stats(spark, spoiled, ["id", "t"], {"id": 77}).drop("path").collect()
    key = lambda r: (r.column, r.min)
    same = [(r.rows, r.column, r.min, r.max, r.nulls, r.may_match) for r in sorted(got, key=key)]
    assert same == [(r.rows, r.column, r.min, r.max, r.nulls, r.may_match) for r in sorted(want, key=key)]


def test_tables_without_rows(spark):
    path = scratch_path(spark, "footer_empty")
    spark.range(0).write.parquet(path)
    row = ft.footer_report(spark, path, {"id": 1}).first()
    assert (row.total_rows, row.groups_to_read, row.rows_to_read) == (0, 0, 0)


def test_executors_need_no_copy_of_the_package(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})  # the driver alone
import __spark_entry__ as entry
from tidepool.session import get_spark
print("rows", entry.queries()["footer_skipping"](get_spark(master="local[4]"), "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3" in done.stdout, done.stderr[-3000:]
