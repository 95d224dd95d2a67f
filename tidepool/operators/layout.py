"""Layout jobs (compaction, z-order, clustering) and layout reports.

Plain parquet folders have no transaction log, so every job reads a folder
and writes a new one; reports are Spark jobs over the folder listing
(``binaryFile`` with the content column pruned, so no file body is read) or
over the data's ``_metadata`` column.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

DEFAULT_TARGET_FILE_BYTES = 256 * 1024 * 1024
RETENTION_HOURS = 168
MAX_CLUSTER_COLUMNS = 4


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of the data files under ``path``."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(path)
            .select("path", "length", "modificationTime"))


def file_report(spark: SparkSession, path: str) -> DataFrame:
    """File count, total and average bytes (one aggregate over the listing)."""
    return list_files(spark, path).agg(
        F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.round(F.avg("length"), 1).alias("avg_file_bytes"))


def compact(spark: SparkSession, src: str, dst: str, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES,
            max_records_per_file: int | None = None) -> str:
    """Rewrite ``src`` into files of about ``target_file_bytes``.

    The read itself packs small files into splits of the target size
    (``spark.sql.files.maxPartitionBytes``), so the rewrite needs no shuffle:
    each task writes one output file from the small files it read.
    """
    # Do not shrink splits to spread a small input over all cores: size wins.
    with _reading(spark, {"spark.sql.files.maxPartitionBytes": target_file_bytes, "spark.sql.files.openCostInBytes": 1,
                          "spark.sql.files.minPartitionNum": 1}):
        df = spark.read.parquet(src)
        w = df.write.mode("overwrite")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        w.parquet(dst)
    return dst


@contextmanager
def _reading(spark: SparkSession, settings: Mapping[str, int]):
    """Session settings of reads; the session gets its own back."""
    conf, old = spark.conf, {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def deal(df: DataFrame, dst: str, num_files: int, split_bytes: int) -> str:
    """Write ``df`` as ``num_files`` files, its rows dealt out evenly.

    Spark sorts the rows of each split before it deals them: splits of at most
    ``split_bytes`` keep that small.
    """
    with _reading(df.sparkSession, {"spark.sql.files.maxPartitionBytes": split_bytes}):
        df.repartition(num_files).write.parquet(dst)
    return dst


#: Bits by which columns that are no numbers are ranked, and distinct values sampled for that.
TEXT_BITS, TEXT_SAMPLE = 6, 10_000


def _as_number(df: DataFrame, c: str) -> Column | None:
    """A column's value as a number that keeps its order, or None."""
    kind = df.schema[c].dataType
    if isinstance(kind, NumericType):
        return F.col(c)
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp"))
    return None


def _quantiles(df: DataFrame, c: str, n: int) -> list:
    """n - 1 values that cut a sample of the column's distinct values into equal parts."""
    sample = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(F.xxhash64(c), c).limit(TEXT_SAMPLE)
    values = [r[0] for r in sample.orderBy(c).collect()]
    return sorted({values[i * len(values) // n] for i in range(1, n)}) if values else []


def _not_above(c: str):
    return lambda x: x <= F.col(c)


def with_zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 8, name: str = "_z",
                    accuracy: int = 1_000) -> DataFrame:
    """Add the Morton key: interleaved bits of each column's rank bucket.

    Numbers, and dates and times as microseconds, are cut at approximate
    percentiles (all columns from one small aggregate row) and bucketed with
    ``Bucketizer`` (a JVM binary search per value). Other types are cut, in
    their own order, at the quantiles of a bounded sample of their distinct
    values: the sample moves the cuts, never a row's presence. NULLs go to
    bucket 0.
    """
    from pyspark.ml.feature import Bucketizer

    n = 1 << bits
    probs = [i / n for i in range(1, n)]
    numbers = {c: _as_number(df, c) for c in cols}
    numeric = [c for c in cols if numbers[c] is not None]
    cuts = {}
    if numeric:
        row = df.agg(*[F.percentile_approx(numbers[c], probs, accuracy).alias(c) for c in numeric]).first()
        cuts = {c: sorted({float(x) for x in row[c] or ()}) for c in numeric}
    out = df
    bucket_cols = []
    for j, c in enumerate(cols):
        bc = f"_zb{j}"
        bucket_cols.append(bc)
        if c in cuts:
            splits = [float("-inf")] + cuts[c] + [float("inf")]
            out = Bucketizer(splits=splits, inputCol=f"_zin{j}", outputCol=bc, handleInvalid="keep") \
                .transform(out.withColumn(f"_zin{j}", numbers[c].cast("double"))).drop(f"_zin{j}")
            out = out.withColumn(bc, F.coalesce(F.col(bc).cast("long"), F.lit(0).cast("long")))
        else:
            coarse = min(bits, TEXT_BITS)
            values = [F.lit(v) for v in _quantiles(df, c, 1 << coarse)]
            below = F.size(F.filter(F.array(*values), _not_above(c))) if values else F.lit(0)
            out = out.withColumn(bc, F.shiftleft(F.coalesce(F.when(F.col(c).isNotNull(), below), F.lit(0)).cast("long"), bits - coarse))
    z = F.lit(0).cast("long")
    k = len(cols)
    for i in range(bits):
        for j, bc in enumerate(bucket_cols):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(F.col(bc), i).bitwiseAND(F.lit(1)), i * k + j))
    return out.withColumn(name, z).drop(*bucket_cols)


def zorder(df: DataFrame, cols: Sequence[str], dst: str, num_files: int, bits: int = 8) -> str:
    """Write ``df`` range-partitioned and sorted by its z-order key."""
    if not 1 <= len(cols) <= 6:
        raise ValueError("z-order takes 1 to 6 columns")
    keyed = with_zorder_key(df, cols, bits)
    # The row's hash ends the range key, so rows of one hot value are spread over files too.
    order = ["_z", *cols, F.xxhash64(*df.columns)]
    (keyed.repartitionByRange(num_files, *order).sortWithinPartitions("_z", *cols).drop("_z")
     .write.mode("overwrite").parquet(dst))
    return dst


@dataclass
class LayoutSpec:
    """Clustering columns of a data set. Changing them rewrites nothing; the
    next ``apply_clustering`` job uses the new list."""

    cluster_by: list[str] = field(default_factory=list)

    def __post_init__(self):
        if len(self.cluster_by) > MAX_CLUSTER_COLUMNS:
            raise ValueError(f"at most {MAX_CLUSTER_COLUMNS} clustering columns")

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "spec string").coalesce(1) \
             .write.mode("overwrite").text(f"{path.rstrip('/')}/_layout_spec")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LayoutSpec:
        row = spark.read.text(f"{path.rstrip('/')}/_layout_spec").first()
        return LayoutSpec(**json.loads(row[0]))


def apply_clustering(df: DataFrame, spec: LayoutSpec, dst: str, num_files: int) -> str:
    """Clustering job: z-order on the spec's columns (range sort for one column)."""
    if len(spec.cluster_by) == 1:
        c = spec.cluster_by[0]
        df.repartitionByRange(num_files, c, F.xxhash64(*df.columns)).sortWithinPartitions(c).write.mode("overwrite").parquet(dst)
        return dst
    return zorder(df, spec.cluster_by, dst, num_files)


def files_for_target(spark: SparkSession, path: str, target_file_bytes: int) -> int:
    total = file_report(spark, path).first()["total_bytes"]
    return max(1, math.ceil(total / target_file_bytes))


def file_stats(spark: SparkSession, path: str, cols: Sequence[str],
               probe: Mapping[str, object] | None = None) -> DataFrame:
    """Per data file: rows and min/max of ``cols`` (what file skipping looks at),
    plus the rows equal to ``probe`` when given."""
    df = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    aggs = [F.count(F.lit(1)).alias("rows")]
    if probe:
        hit = F.lit(True)
        for c, v in probe.items():
            hit = hit & (F.col(c) == F.lit(v))
        aggs.append(F.count(F.when(hit, 1)).alias("probe_rows"))
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.groupBy("_file").agg(*aggs)


def skipping_report(spark: SparkSession, path: str, probe: Mapping[str, object]) -> DataFrame:
    """How many files a point filter must read: files whose [min, max] ranges
    contain every probe value, out of all files."""
    stats = file_stats(spark, path, list(probe), probe)
    may_match = F.lit(True)
    for c, v in probe.items():
        may_match = may_match & (F.col(f"{c}_min") <= F.lit(v)) & (F.col(f"{c}_max") >= F.lit(v))
    return stats.agg(F.count(F.lit(1)).alias("total_files"),
                     F.count(F.when(may_match, 1)).alias("files_to_read"),
                     F.sum("rows").alias("total_rows"), F.sum("probe_rows").alias("probe_rows"))


def orphan_files(spark: SparkSession, path: str, referenced: DataFrame, now_ms: int,
                 retention_hours: int = RETENTION_HOURS) -> DataFrame:
    """Files under ``path`` that no live version references and that are older
    than the retention window (what a clean-up would delete)."""
    cutoff = F.lit(now_ms - retention_hours * 3600 * 1000).cast("long")
    listing = list_files(spark, path).withColumn(
        "mtime_ms", (F.unix_micros(F.col("modificationTime")) / 1000).cast("long"))
    return (listing.join(referenced.select(F.col("path")), "path", "left_anti")
            .withColumn("older_than_retention", F.col("mtime_ms") < cutoff))
