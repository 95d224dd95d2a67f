"""File sources: CSV/JSON/Parquet readers, permissive split, schema hints and
evolution, rescued data, and an idempotent incremental loader (COPY INTO).

Everything is a DataFrame job; the loader's file listing is one too, and its
paths reach the driver a batch at a time.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"


def write_files(df: DataFrame, path: str, fmt: str, n_files: int, deal: bool = True, **options) -> str:
    """Land a DataFrame as ``n_files`` files, or a multiple as its input has more splits (fixture helper).

    With ``deal=False`` an input of ``n_files`` splits or more lands as it lies, a file a split, without a shuffle.
    """
    splits = df.rdd.getNumPartitions()
    rows = df.repartition(n_files * math.ceil(max(n_files, splits) / n_files)) if deal or splits < n_files else df
    w = rows.write.mode("overwrite").format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def files_a_trigger(spark: SparkSession, path: str, batches: int) -> int:
    """``maxFilesPerTrigger`` by which a stream reads a landing folder in ``batches`` micro-batches, however many files it has."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").count()
    return max(1, math.ceil(files / batches))


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
             schema: StructType | str | None = None, infer: bool = True) -> DataFrame:
    r = spark.read.option("header", header).option("sep", sep)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    return r.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              primitives_as_string: bool = False) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    elif primitives_as_string:
        r = r.option("primitivesAsString", True)
    return r.json(path)


def read_csv_permissive(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
                        header: bool = True) -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE read; returns (good rows, malformed rows with the raw line).

    A NULL value is a valid reading; only lines that do not parse against the
    schema go to the bad side.
    """
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    df = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).schema(full).csv(path))
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull())
    return good, bad


def unify(frames: Sequence[tuple[DataFrame, Mapping[str, str]]], schema: StructType) -> DataFrame:
    """Rename each source's columns to the target names, cast, union by name."""
    out = None
    for df, renames in frames:
        d = df.withColumnsRenamed(dict(renames))
        d = d.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in d.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        out = d if out is None else out.unionByName(d)
    return out


def with_source_metadata(df: DataFrame, source_name: str | None = None) -> DataFrame:
    """Bronze metadata: source file path, ingest time, optional literal source name."""
    out = df.withColumn("_source_file", F.col("_metadata.file_path")) \
            .withColumn("_ingested_at", F.current_timestamp())
    return out.withColumn("_source_system", F.lit(source_name)) if source_name else out


def parse_ddl_hints(hints: str) -> dict[str, DataType]:
    """'amount DOUBLE, id STRING' -> {name: type}."""
    return {f.name: f.dataType for f in StructType.fromDDL(hints).fields}


def infer_with_hints(spark: SparkSession, path: str, fmt: str, hints: str,
                     sampling_ratio: float = 1.0, **options) -> StructType:
    """Infer the schema with the batch reader (optionally sampled), then let the hints win."""
    r = spark.read.format(fmt).option("samplingRatio", sampling_ratio)
    for k, v in options.items():
        r = r.option(k, v)
    inferred = r.load(path).schema
    hinted = parse_ddl_hints(hints)
    fields = [StructField(f.name, hinted.get(f.name, f.dataType), True) for f in inferred.fields]
    fields += [StructField(n, t, True) for n, t in hinted.items() if n not in inferred.fieldNames()]
    return StructType(fields)


def merge_schemas(saved: StructType | None, new: StructType, mode: str = "addNewColumns") -> StructType:
    """Schema evolution between runs.

    ``addNewColumns`` appends unseen columns; ``failOnNewColumns`` raises;
    ``rescue`` and ``none`` keep the saved schema (unknown fields go to the
    rescued column, or are ignored).
    """
    if saved is None:
        return new
    extra = [f for f in new.fields if f.name not in saved.fieldNames()]
    if not extra:
        return saved
    if mode == "addNewColumns":
        return StructType(list(saved.fields) + [StructField(f.name, f.dataType, True) for f in extra])
    if mode == "failOnNewColumns":
        raise ValueError(f"new columns in input: {[f.name for f in extra]}")
    return saved


def _typed(raw: Column, dtype: DataType) -> Column:
    name = dtype.simpleString()
    if name == "timestamp":
        return F.try_to_timestamp(raw)
    if name == "string":
        return raw
    return raw.try_cast(dtype)


def parse_with_rescue(lines: DataFrame, schema: StructType, line_col: str = "value") -> DataFrame:
    """JSON lines -> typed columns plus ``_rescued_data``.

    Values that do not fit their column's type become NULL and are kept, with
    fields the schema does not know, in ``_rescued_data`` (a JSON object; NULL
    when nothing was rescued). Lines that are not JSON objects keep the whole
    line under ``_corrupt``.
    """
    raw = F.from_json(F.col(line_col), "map<string,string>")
    df = lines.select(raw.alias("_raw"), F.col(line_col).alias("_line"))
    # Each value is typed once: the steps stay apart in the plan, as later ones use what they make more than once.
    typed = {f"_typed{i}": f for i, f in enumerate(schema.fields)}
    df = df.select("_raw", "_line", *[_typed(F.col("_raw")[f.name], f.dataType).alias(c) for c, f in typed.items()])
    misfits = [F.when(F.col("_raw")[f.name].isNotNull() & F.col(c).isNull(), F.lit(f.name)) for c, f in typed.items()]
    df = df.withColumn("_misfits", F.array_compact(F.array(*misfits)))
    known = F.array(*[F.lit(k) for k in schema.fieldNames()])
    unknown = F.size(F.array_except(F.map_keys("_raw"), known)) > 0
    rescued_map = F.map_filter("_raw", lambda k, v: ~F.array_contains(known, k) | F.array_contains("_misfits", k))
    rescued = F.when(F.col("_raw").isNull(), F.to_json(F.create_map(F.lit("_corrupt"), F.col("_line")))) \
               .when(unknown | (F.size("_misfits") > 0), F.to_json(rescued_map))
    df = df.select(*typed, rescued.alias("_rescued"))
    return df.select(*[F.col(c).alias(f.name) for c, f in typed.items()], F.col("_rescued").alias(RESCUED))


#: Files loaded as one batch; the driver never holds more paths than these.
FILES_PER_BATCH = 10_000


def copy_into(spark: SparkSession, source_dir: str, fmt: str, schema: StructType | None, target_path: str,
              ledger_path: str, options: Mapping[str, str] | None = None, glob: str | None = None) -> int:
    """Idempotent incremental load (COPY INTO): each file is loaded once.

    Protocol, safe against a crash at any point:
    1. list the landing folder (``binaryFile`` with the content column pruned,
       so no file body is read) and subtract every file the ledger knows;
       All data files count, whatever their suffix, unless ``glob`` names some;
    2. take them in batches of at most ``FILES_PER_BATCH``, and record each batch's
       files in the ledger as ``pending`` under a fresh batch id;
    3. write their rows into the target partition ``_load_batch=<id>`` with
       dynamic partition overwrite (rewriting a batch replaces it, never doubles it);
    4. record the batch as ``done``.
    A later run first redoes batches that are pending without a done mark, so
    the target itself is never scanned. Without a ``schema`` each batch is read
    with the schema inferred from its files, and :func:`read_loaded` merges the
    schemas: rows of older batches have NULL in newer columns. Returns the
    number of newly loaded files.
    """
    import uuid
    from itertools import batched

    def load(files: list[str], batch_id: str) -> None:
        r = spark.read.format(fmt)
        if schema is not None:
            r = r.schema(schema)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        rows = r.load(files).withColumn("_source_file", F.col("_metadata.file_path")) \
                .withColumn("_load_batch", F.lit(batch_id))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_load_batch").parquet(target_path))
        _ledger_append(spark, ledger_path, [(f, batch_id, "done") for f in files])

    ledger = _read_ledger(spark, ledger_path)
    if ledger is not None:
        done = ledger.filter(F.col("status") == "done").select("batch_id").distinct()
        unfinished = ledger.filter(F.col("status") == "pending").join(done, "batch_id", "left_anti")
        for batch_id, files in _group_files(unfinished.select("batch_id", "_source_file").collect()).items():
            load(files, batch_id)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = (reader.option("pathGlobFilter", glob) if glob else reader).load(source_dir).select(F.col("path").alias("_source_file"))
    known = ledger.select("_source_file") if ledger is not None else None
    new_files = listing.join(known, "_source_file", "left_anti") if known is not None else listing
    loaded = 0
    # The anti join ran against the ledger as it was: loading a batch doesn't disturb the next.
    for rows in batched(new_files.toLocalIterator(), FILES_PER_BATCH):
        paths, batch_id = [r[0] for r in rows], uuid.uuid4().hex
        _ledger_append(spark, ledger_path, [(f, batch_id, "pending") for f in paths])
        load(paths, batch_id)
        loaded += len(paths)
    return loaded


def read_loaded(spark: SparkSession, target_path: str) -> DataFrame:
    """The loaded rows of all batches' columns, without the load bookkeeping columns."""
    return spark.read.option("mergeSchema", "true").parquet(target_path).drop("_source_file", "_load_batch")


def _group_files(rows) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for batch_id, f in rows:
        out.setdefault(batch_id, []).append(f)
    return out


def _read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame | None:
    """The ledger, or None if its path isn't there; any other error rises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(ledger_path)


def _ledger_append(spark: SparkSession, ledger_path: str, entries) -> None:
    spark.createDataFrame(entries, "_source_file string, batch_id string, status string") \
         .withColumn("_logged_at", F.current_timestamp()).write.mode("append").parquet(ledger_path)
