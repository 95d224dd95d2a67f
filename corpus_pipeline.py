"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, mixing.

Each stage takes what its predecessor kept, whole, and all but the last return
the columns of ``documents``. The last returns the documents that the mix takes,
in order of their first passes, with size, source_size, target, taken, position
and the positions of all passes beside their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import read, written
from tidepool.llm.decontaminate import decontaminate
from tidepool.llm.mixing import curriculum
from tidepool.llm.quality_rules import quality_filter
from tidepool.llm.simhash import deduplicate
from tidepool.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return deduplicate(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that stand earlier; n_chars follows the text."""
    found = remove_repeats(docs)
    kept = {"text": F.col("kept_text"),
            "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars"))}
    return found.select(*(kept.get(c, F.col(f"row.{c}")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in order of their first passes, with the positions of all."""
    return curriculum(docs).select("row.*", "size", "source_size", "target", "taken", "position",
                                   F.col("passes.position").alias("positions"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]

#: Near-dedup's components are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
