"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A word is a longest run of characters outside this class.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame, with DuckDB SQL if it has any."""

    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return deco


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Cuts the lineage: later steps, and the recovery of lost executors, read the
    files and don't run ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
