"""Distinct counts that add up: one stored HyperLogLog sketch per day and group.

A sketch is a fixed-size value, and the union of the sketches of two row sets is
the sketch of both together. So events are read once, on the day they arrive,
and counts over any range of days are merged from the stored rows. Partial
sketches are built before the shuffle, so a day or group with a third of all
rows sends one sketch per map task.

NULL values are not counted, a group of only NULLs counts 0. NULL days and NULL
groups are groups of their own.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegralType, StringType

from ..sources.sinks import overwrite_partitions

#: Base-2 logarithm of a sketch's registers: 4,096 of them, at most some 3 kB a sketch.
LG_K = 12


def relative_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Bound of the relative error of a merged count at so many standard errors."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def _value(df: DataFrame, c: str) -> Column:
    kind = df.schema[c].dataType
    if isinstance(kind, IntegralType):
        return F.col(c).cast("long")
    return F.col(c) if isinstance(kind, (StringType, BinaryType)) else F.col(c).cast("string")


def sketch_by(df: DataFrame, by: Sequence[str], values: Mapping[str, str], lg_k: int = LG_K) -> DataFrame:
    """Per group of ``by``: ``n_rows`` and, for each (name, column) of ``values``, its sketch as ``name``."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               *[F.hll_sketch_agg(_value(df, c), lg_k).alias(name) for name, c in values.items()])


def store_daily(df: DataFrame, path: str, day: str, by: Sequence[str], values: Mapping[str, str],
                lg_k: int = LG_K) -> str:
    """Write the sketches of ``df``'s days under ``path``, a folder per day.

    Days of ``df`` that are stored already are replaced, so a repeated or corrected
    load counts nothing twice; give the whole rows of each day.
    """
    return overwrite_partitions(sketch_by(df, [day, *by], values, lg_k), path, [day])


def merge_sketches(stored: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per group of ``by``: ``n_rows`` summed and the union of the sketches, which can be merged further."""
    return stored.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"),
                                   *[F.hll_union_agg(c).alias(c) for c in names])


def estimates(sketched: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sketches replaced by the counts that they estimate."""
    return sketched.withColumns({c: F.hll_sketch_estimate(c) for c in names})


def trailing_days(stored: DataFrame, day: str, by: Sequence[str], names: Sequence[str], days: int) -> DataFrame:
    """Merged sketches of the trailing ``days`` days for every stored day.

    Each stored row, a sketch and no event, goes to the ``days`` windows that it lies in.
    """
    spread = stored.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    moved = spread.withColumn(day, F.date_add(day, F.col("_ahead")))
    seen = stored.select(day, *by).distinct()
    return merge_sketches(moved, [day, *by], names).join(seen, [day, *by], "left_semi")
