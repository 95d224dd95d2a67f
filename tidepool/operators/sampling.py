"""Samples of an exact size per stratum that can be repeated and merged.

A row's place is the MD5 of a seed and its key, and a stratum's sample is the
``n`` rows with the smallest places (bottom-k). The choice depends on keys only,
so any partitioning, retry or engine draws the same rows, and the sample of a
union is drawn from the samples of its parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import top_n_per_group


def place(keys: Sequence[str], seed: int = 0) -> Column:
    """Hex digits that order rows at random: MD5 of ``seed:key1:key2...``, NULL written as ``\\N``."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def bottom_k(df: DataFrame, strata: Sequence[str], keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of every stratum (all rows of a smaller one), without replacement.

    ``keys`` name a row: rows with equal keys have one place, and which of them is
    drawn at the edge is not defined. A NULL stratum is a stratum. Map tasks pass on
    at most ``n`` rows a stratum, so a hot stratum costs no more than others.
    """
    ranked = df.withColumn("_place", place(keys, seed))
    return top_n_per_group(ranked, strata, [F.col("_place"), *[F.col(k) for k in keys]], n).drop("_place")


def merge_samples(a: DataFrame, b: DataFrame, strata: Sequence[str], keys: Sequence[str], n: int,
                  seed: int = 0) -> DataFrame:
    """The sample of two disjoint row sets from the samples of each, drawn with the same ``n`` and ``seed``."""
    return bottom_k(a.unionByName(b), strata, keys, n, seed)


def with_weights(sample: DataFrame, population: DataFrame, strata: Sequence[str], name: str = "weight") -> DataFrame:
    """Add the rows of its stratum that each drawn row stands for (size of the stratum over size of its sample)."""
    alias = {c: f"_s{i}" for i, c in enumerate(strata)}
    drawn = sample.groupBy(*strata).agg(F.count(F.lit(1)).alias("_drawn"))
    sizes = population.groupBy(*strata).agg(F.count(F.lit(1)).alias("_size"))
    same_d, same_s = F.lit(True), F.lit(True)
    for c, a in alias.items():
        drawn, sizes = drawn.withColumnRenamed(c, a), sizes.withColumnRenamed(c, a + "p")
        same_d, same_s = same_d & F.col(a).eqNullSafe(F.col(a + "p")), same_s & F.col(c).eqNullSafe(F.col(a))
    rates = drawn.join(sizes, same_d).withColumn(name, F.col("_size") / F.col("_drawn")).select(*alias.values(), name)
    return sample.join(rates, same_s).drop(*alias.values())
