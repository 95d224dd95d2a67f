"""Hot keys: which they are, and how rows of one key are dealt over many tasks.

``frequent_hashes`` finds the keys that hold at least one row in ``SHARE`` with
Spark's mergeable frequency sketch (``approx_top_k``): every task sketches its
rows and only sketches are shuffled. There are at most ``SHARE`` such keys, so
the list is small whatever the table. Keys go by their 64-bit hash; an unlucky
hash makes a key spread that need not be, and changes no result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: A key is hot if it holds at least one row of so many.
SHARE = 256
#: Entries that a sketch tracks; its counts are off by a share of less than 1 / (0.75 * TRACKED).
TRACKED = 8192
#: Rows of a hot key that one task shall take, and the least number of tasks for one.
ROWS_PER_SALT, MIN_SALTS = 1 << 20, 64


def hashable(t: DataType) -> bool:
    """Whether Spark's hash functions take the type: no map or variant in it."""
    if isinstance(t, ArrayType):
        return hashable(t.elementType)
    if isinstance(t, StructType):
        return all(hashable(f.dataType) for f in t.fields)
    return not isinstance(t, (MapType, VariantType))


def row_hash(df: DataFrame) -> Column:
    """A hash that spreads rows, equal ones too: of the columns that can be hashed and of the input partition.

    A recomputed task gives its rows the same values again.
    """
    return F.xxhash64(F.spark_partition_id(), *[F.col(f.name) for f in df.schema.fields if hashable(f.dataType)])


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def frequent_hashes(df: DataFrame, keys: Sequence[str], share: int = SHARE) -> dict[int, int]:
    """Hash and estimated number of rows of every key with at least one row of ``share``; at most ``share`` entries.

    One job that reads the key columns. Rows with a NULL key part are left out.
    """
    rows = df.select(*keys).dropna().select(key_hash(keys).alias("h"))
    found = rows.agg(F.expr(f"approx_top_k(h, {share}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {x["item"]: x["count"] for x in found.top if x["count"] * share >= found.n and x["count"] > 1}


def salts(keys: Sequence[str], hot: Mapping[int, int]) -> Column:
    """Over how many tasks a row's key is dealt: 1 unless it is hot."""
    if not hot:
        return F.lit(1)
    table = F.create_map(*[F.lit(x).cast("long") if i % 2 == 0 else F.lit(x) for h, n in hot.items()
                           for i, x in enumerate((h, max(MIN_SALTS, -(-n // ROWS_PER_SALT))))])
    return F.coalesce(F.try_element_at(table, key_hash(keys)), F.lit(1))


def is_hot(keys: Sequence[str], hot: Mapping[int, int]) -> Column:
    return F.coalesce(key_hash(keys).isin(list(hot)), F.lit(False)) if hot else F.lit(False)
