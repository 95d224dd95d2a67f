"""Auto-CDC (type-2 history) from a change stream, by splicing.

The history is a folder of append-only tables; a micro-batch writes one part of each:

* ``changes``: its changes;
* ``versions``: the versions that it made or changed, those of deleted keys too;
* ``cuts``: for each key of the batch the sequence value from which on its versions of earlier batches no longer count;
* ``state``, replaced for the key buckets of the batch: a row per key with its last version and last sequence value.

A key whose new changes all come after its last one continues from ``state``: its last version is a seed, put
before the new changes, and the operators of ``auto_cdc_scd2`` run over seed and changes alone. A key with a late change
is spliced: the version in force before its least new sequence value is the cut; the changes from there
on are read again (Parquet statistics skip older row groups), with the version before it as a seed. So a batch
costs what its keys and changes cost, and not what the history does. ``cdc_history`` reads the versions that no cut covers.

A batch that runs again replaces its own parts and never reads them, so a crash between two writes changes nothing;
where ``state`` already knows a replayed change, the key takes the late path, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.merge import BUCKET_COL, bucket_of
from ..operators.scan import ONE_TASK_BYTES, estimated_bytes, keyed_running
from ..operators.scd import cdc_changes, cdc_versions
from .runner import drain


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def _parts(spark: SparkSession, path: str, name: str, schema: StructType, before: int | None = None) -> DataFrame | None:
    """The parts of a table that batches up to ``before`` wrote, with their column batch; None if there is none yet."""
    folder = f"{path.rstrip('/')}/{name}"
    if not _exists(spark, folder):
        return None
    df = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(folder)
    return df.filter(F.col("batch") <= before) if before is not None else df


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def has_hot_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the rows of some key may be too many for one task, by its share of the estimated bytes."""
    size = estimated_bytes(df)
    if size <= ONE_TASK_BYTES:
        return False
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return bool(rows[1]) and size * rows[0] / rows[1] > ONE_TASK_BYTES


def live_versions(versions: DataFrame, cuts: DataFrame, keys: Sequence[str], spread: bool | str = "auto") -> DataFrame:
    """``versions`` that no cut of a later batch covers: a running maximum of the cuts' batches in the order of sequence values."""
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in versions.schema.fields if f.name not in (*keys, "batch")]
    events = versions.select("*", F.col("_start").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_cut")).unionByName(
        cuts.select(*keys, *blank, F.col("batch"), F.col("_from").alias("_at"), F.lit(0).alias("_kind"), F.col("batch").alias("_cut")))
    seen = keyed_running(events, keys, ["_at", "_kind", "batch"], maxes=[("_cut", "_last_cut")], spread=spread)
    return seen.filter((F.col("_kind") == 1) & (F.col("_last_cut").isNull() | (F.col("batch") >= F.col("_last_cut")))).select(versions.columns)


class CdcTable:
    """The tables of one history: their schemas follow from a change table's."""

    def __init__(self, changes: DataFrame, keys: Sequence[str], sequence_by: str, path: str, num_buckets: int = 64,
                 tracked: Sequence[str] | None = None, ignore_null_updates: bool = True, **change_options):
        self.spark, self.keys, self.sequence_by, self.path, self.n = changes.sparkSession, list(keys), sequence_by, path.rstrip("/"), num_buckets
        self.options, self.ignore = change_options, ignore_null_updates
        rows, self.payload = cdc_changes(changes, self.keys, sequence_by, **change_options)
        self.tracked = list(tracked) if tracked is not None else self.payload
        self.rows = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
        seq = self.rows["_seq"].dataType
        ids, values = [self.rows[k] for k in self.keys], [self.rows[c] for c in self.payload]
        gone = self.rows["_del"]
        self.versions = StructType([*ids, *values, gone, StructField("_start", seq), StructField("_end", seq)])
        self.cuts = StructType([*ids, StructField("_from", seq)])
        self.state = StructType([*ids, *values, gone, StructField("_start", seq), StructField("_last", seq)])

    def _write(self, df: DataFrame, name: str, schema: StructType, batch: int) -> DataFrame:
        folder = f"{self.path}/{name}/batch={batch}"
        df.select(*schema.names).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def _of(self, df: DataFrame, some: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows of ``df`` whose key is in ``some``."""
        return df.alias("l").join(some.select(*self.keys).alias("r"), _same("l", "r", self.keys), how)

    def _late(self, late: DataFrame, batch: int) -> tuple[DataFrame, DataFrame, bool]:
        """For keys (with _first, their least new sequence value): changes from the cut on, seeds, and whether those of some key may be too many for one task."""
        keys = self.keys
        versions = _parts(self.spark, self.path, "versions", self.versions, batch - 1)
        cuts = _parts(self.spark, self.path, "cuts", self.cuts, batch - 1)
        known = live_versions(self._of(versions, late), self._of(cuts, late), keys, has_hot_key(versions, keys)).alias("v")
        joined = known.join(late.alias("k"), _same("v", "k", keys)).filter(F.col("_start") < F.col("_first"))
        cut = joined.groupBy(*[F.col(f"k.{k}").alias(k) for k in keys]).agg(F.max("_start").alias("_cut"))
        cut = late.alias("a").join(cut.alias("b"), _same("a", "b", keys), "left").select(
            "a.*", F.coalesce("_cut", "_first").alias("_from"), F.col("_cut").isNotNull().alias("_spliced"))
        cuts_made = self._write(cut, "cuts", self.cuts, batch)  # in-order keys add theirs below
        cut = cuts_made.alias("c")
        # The version before the cut: its last values are those before the cut's first change.
        before = known.join(cut, _same("v", "c", keys)).filter(F.col("v._start") < F.col("c._from"))
        row = F.struct(*[F.col(f"v.{c}").alias(c) for c in self.payload], F.col("v._del").alias("_del"))
        before = before.groupBy(*[F.col(f"c.{k}").alias(k) for k in keys], F.col("c._from").alias("_seq")).agg(
            F.max_by(row, F.struct("v._start", F.coalesce("v._end", "v._start"))).alias("_row"))
        seeds = before.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in self.payload], "_seq",
                              F.lit(None).cast(self.rows["_tie"].dataType).alias("_tie"), F.col("_row._del").alias("_del"))
        # No change before the earliest cut is needed: the literal bound reaches the Parquet statistics.
        least = cuts_made.agg(F.min("_from")).first()[0]
        log = _parts(self.spark, self.path, "changes", self.rows, batch).filter(F.col("_seq") >= F.lit(least))
        again = log.alias("l").join(cut, _same("l", "c", keys)).filter(F.col("l._seq") >= F.col("c._from")).select(
            *[F.col(f"l.{c}") for c in self.rows.names])
        return again, seeds, has_hot_key(log, keys)

    def apply(self, batch_changes: DataFrame, batch: int) -> None:
        """One micro-batch."""
        keys = self.keys
        rows, _ = cdc_changes(batch_changes, keys, self.sequence_by, **self.options)
        new = self._write(rows, "changes", self.rows, batch)
        firsts = new.groupBy(*keys).agg(F.min("_seq").alias("_first"), F.max("_seq").alias("_newest"))
        firsts = firsts.withColumn(BUCKET_COL, bucket_of(keys, self.n))
        touched = sorted(r[0] for r in firsts.select(BUCKET_COL).distinct().collect())  # at most num_buckets
        if not touched:
            return
        state_dir, schema = f"{self.path}/state", StructType([*self.state.fields, StructField(BUCKET_COL, LongType())])
        state = (self.spark.read.schema(schema).parquet(state_dir) if _exists(self.spark, state_dir)
                 else self.spark.createDataFrame([], schema)).filter(F.col(BUCKET_COL).isin(touched))
        found = firsts.alias("f").join(state.alias("s"), _same("f", "s", keys), "left").select(
            *[F.col(f"f.{c}") for c in (*keys, "_first", "_newest")], F.struct(*[F.col(f"s.{c}") for c in self.state.names]).alias("_s"),
            (F.col("s._last").isNotNull() & (F.col("f._first") <= F.col("s._last"))).alias("_late"))
        found = self.spark.read.schema(found.schema).parquet(self._scratch(found, batch))
        late, on_time = found.filter("_late"), found.filter("NOT _late")
        # Keys in order, and new keys: the last version is the seed and goes on.
        goes_on = on_time.filter(F.col("_s._last").isNotNull())
        seeds = goes_on.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in self.payload], F.col("_s._last").alias("_seq"),
                               F.lit(None).cast(self.rows["_tie"].dataType).alias("_tie"), F.col("_s._del").alias("_del"))
        made = cdc_versions(self._of(new, on_time).unionByName(seeds), keys, self.payload, self.tracked, self.ignore, spread=has_hot_key(new, keys))
        made = made.alias("v").join(goes_on.select(*keys, F.col("_s._start").alias("_begun")).alias("g"), _same("v", "g", keys), "left")
        made = made.select("v.*", F.when(F.col("v._seed"), F.col("_begun")).otherwise(F.col("v._start")).alias("_at"))
        made = made.drop("_start").withColumnRenamed("_at", "_start").select(*self.versions.names)
        cuts = goes_on.select(*keys, F.col("_s._start").alias("_from"))
        if not late.isEmpty():
            again, before, many = self._late(late, batch)
            spliced = cdc_versions(again.unionByName(before), keys, self.payload, self.tracked, self.ignore, spread=many)
            made = made.unionByName(spliced.filter(~F.col("_seed")).select(*self.versions.names))
            cuts.select(*self.cuts.names).write.mode("append").parquet(f"{self.path}/cuts/batch={batch}")
        else:
            self._write(cuts, "cuts", self.cuts, batch)
        made = self._write(made, "versions", self.versions, batch)
        # The state of the touched buckets: keys of this batch anew, the others as they were.
        last = made.filter(F.col("_end").isNull()).alias("v").join(found.alias("k"), _same("v", "k", keys)).select(
            *[F.col(f"v.{c}") for c in self.state.names if c != "_last"], F.greatest("_newest", F.col("_s._last")).alias("_last"))
        after = self._of(state.select(*self.state.names), firsts, "left_anti").unionByName(last.select(*self.state.names))
        after = after.withColumn(BUCKET_COL, bucket_of(keys, self.n))
        staged = self._scratch(after, batch)
        (self.spark.read.schema(after.schema).parquet(staged).repartition(BUCKET_COL).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL).parquet(state_dir))

    def _scratch(self, df: DataFrame, batch: int) -> str:
        """``df`` written beside the tables, for this batch alone; the next batch uses the folders again."""
        folder = f"{self.path}/_batch/{'keys' if '_late' in df.columns else 'state'}"
        df.write.mode("overwrite").parquet(folder)
        return folder

    def history(self, start_col: str = "__START_AT", end_col: str = "__END_AT") -> DataFrame:
        """The type-2 history after the last batch, as ``auto_cdc_scd2`` gives it."""
        versions = _parts(self.spark, self.path, "versions", self.versions)
        if versions is None:
            versions = self.spark.createDataFrame([], StructType([*self.versions.fields, StructField("batch", LongType())]))
        cuts = _parts(self.spark, self.path, "cuts", self.cuts)
        live = live_versions(versions, cuts, self.keys, has_hot_key(versions, self.keys)) if cuts is not None else versions
        return live.filter(~F.col("_del")).select(*self.keys, *self.payload, F.col("_start").alias(start_col), F.col("_end").alias(end_col))


def auto_cdc_stream(changes: DataFrame, keys: Sequence[str], sequence_by: str, table_path: str, checkpoint: str,
                    num_buckets: int = 64, **cdc_kw) -> CdcTable:
    """Drain ``changes`` (a streaming DataFrame) into a type-2 history; ``.history()`` of the result reads it."""
    table = CdcTable(changes, keys, sequence_by, table_path, num_buckets, **cdc_kw)
    drain(changes, None, checkpoint, foreach_batch=table.apply)
    return table
