"""Nested-data helpers: building and flattening arrays, structs and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], name: str, parts: int = 1) -> DataFrame:
    """Group rows into sorted arrays of structs: one row per key.

    With ``parts`` above 1 the grain is one row per key and part (a hash of the
    fields; the part is not returned), whatever a key's size: use it where keys
    may be larger than one array should be. Exploding gives back every row.
    """
    by = [F.col(k) for k in keys]
    if parts > 1:
        by.append(F.pmod(F.xxhash64(*fields), F.lit(parts)).alias("_part"))
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name)).drop("_part")


def explode_struct_array(df: DataFrame, array_col: str, prefix: str = "", outer: bool = False) -> DataFrame:
    """Explode an array of structs and lift the struct fields to columns."""
    fn = F.explode_outer if outer else F.explode
    elem = f"_{array_col}_elem"
    exploded = df.select("*", fn(array_col).alias(elem)).drop(array_col)
    fields = [f.name for f in exploded.schema[elem].dataType.fields]
    return exploded.select(*[c for c in exploded.columns if c != elem],
                           *[F.col(f"{elem}.{f}").alias(prefix + f) for f in fields])
