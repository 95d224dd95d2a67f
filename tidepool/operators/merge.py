"""MERGE as a DataFrame operator: ordered clauses, first match wins.

``merge(target, source, on, clauses)`` returns the new target rows. Clause
conditions and assignments are SQL strings or Columns that refer to the target
as ``t`` and the source as ``s`` (``"s.updated_at > t.updated_at"``).

Semantics (the SQL MERGE rules):
* a target row and a source row match when all ``on`` keys are equal; NULL
  keys never match;
* matched rows take the first WHEN MATCHED clause whose condition holds
  (update or delete); if none holds the target row is kept as is;
* source-only rows take the first WHEN NOT MATCHED clause (insert); if none
  holds they are dropped;
* target-only rows take the first WHEN NOT MATCHED BY SOURCE clause (update or
  delete); if none holds they are kept;
* two source rows matching one target row is an error when a matched clause
  exists.

Plan: one full outer join of target and source on the keys, so each side is
scanned and shuffled once; insert-only merges take an anti join instead. Rows
with a NULL key are spread by a salt. One job before that looks for repeated
source keys, where a matched clause exists.

Hot keys: a full outer join is never split by AQE, so the join key gets a salt.
A frequency sketch of either side finds the keys with many rows (``skew.py``).
Target rows of such a key are dealt over its salts and the source row is
repeated once for each; a source row whose hot key the target lacks is dealt out like
one with a NULL key. A presence aggregate (the hot keys that the target
has) tells the two apart, and drops those repeats that meet no target row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_folders
from .skew import frequent_hashes, is_hot, row_hash, salts

STAR = "*"


def _expr(e) -> Column | None:
    if e is None:
        return None
    return F.expr(e) if isinstance(e, str) else e


@dataclass
class WhenMatched:
    condition: str | Column | None = None
    update: Mapping[str, str | Column] | str | None = None  # "*" = all columns
    delete: bool = False


@dataclass
class WhenNotMatched:
    condition: str | Column | None = None
    insert: Mapping[str, str | Column] | str = STAR


@dataclass
class WhenNotMatchedBySource:
    condition: str | Column | None = None
    update: Mapping[str, str | Column] | None = None
    delete: bool = False


class MergeAmbiguityError(ValueError):
    pass


@dataclass
class MergeBuilder:
    """Fluent form: ``MergeBuilder(t, s, ["id"]).whenMatchedUpdateAll()...execute()``."""

    target: DataFrame
    source: DataFrame
    on: Sequence[str]
    clauses: list = field(default_factory=list)
    evolve: bool = False
    spread_hot_keys: bool | str = "auto"

    def whenMatchedUpdateAll(self, condition=None):
        self.clauses.append(WhenMatched(condition, update=STAR))
        return self

    def whenMatchedUpdate(self, set, condition=None):  # noqa: A002 - mirrors the SQL word
        self.clauses.append(WhenMatched(condition, update=set))
        return self

    def whenMatchedDelete(self, condition=None):
        self.clauses.append(WhenMatched(condition, delete=True))
        return self

    def whenNotMatchedInsertAll(self, condition=None):
        self.clauses.append(WhenNotMatched(condition, insert=STAR))
        return self

    def whenNotMatchedInsert(self, values, condition=None):
        self.clauses.append(WhenNotMatched(condition, insert=values))
        return self

    def whenNotMatchedBySourceDelete(self, condition=None):
        self.clauses.append(WhenNotMatchedBySource(condition, delete=True))
        return self

    def whenNotMatchedBySourceUpdate(self, set, condition=None):  # noqa: A002
        self.clauses.append(WhenNotMatchedBySource(condition, update=set))
        return self

    def withSchemaEvolution(self):
        self.evolve = True
        return self

    def withHotKeys(self, spread: bool | str = True):
        self.spread_hot_keys = spread
        return self

    def execute(self) -> DataFrame:
        return merge(self.target, self.source, self.on, self.clauses, evolve=self.evolve,
                     spread_hot_keys=self.spread_hot_keys)


def add_missing_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Add the columns of ``like`` that ``df`` lacks, as typed NULLs."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields if f.name not in have]
    return df.select("*", *extra) if extra else df


def check_unique_matches(target: DataFrame, source: DataFrame, on: Sequence[str]) -> None:
    """Raise when two source rows would modify the same target row.

    Only when the source repeats a key is the target consulted, and then only
    against the repeated keys.
    """
    dup_keys = source.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*on)
    if dup_keys.isEmpty():
        return
    # Distinct keys: a hot target key leaves one row a task before the shuffle.
    dup = dup_keys.join(target.select(*on).distinct(), list(on), "left_semi")
    if not dup.isEmpty():
        raise MergeAmbiguityError(
            "MERGE: multiple source rows matched the same target row; deduplicate the source first")


def merge(target: DataFrame, source: DataFrame, on: Sequence[str], clauses: Sequence,
          evolve: bool = False, check_ambiguity: bool = True, spread_hot_keys: bool | str = "auto") -> DataFrame:
    """The rows of ``target`` after the MERGE.

    ``spread_hot_keys``: True looks for hot keys on both sides, False on none, "auto" on a side whose plan's
    size estimate is above what one task can hold anyway. The result is the same.
    """
    on = list(on)
    matched = [c for c in clauses if isinstance(c, WhenMatched)]
    inserts = [c for c in clauses if isinstance(c, WhenNotMatched)]
    by_source = [c for c in clauses if isinstance(c, WhenNotMatchedBySource)]

    out_cols = list(target.columns)
    types = {f.name: f.dataType for f in target.schema.fields}
    if evolve:
        for f in source.schema.fields:
            if f.name not in types:
                out_cols.append(f.name)
                types[f.name] = f.dataType
    src_cols = set(source.columns)

    if matched and check_ambiguity:
        check_unique_matches(target, source, on)

    hot_target = hot_keys(target, on, spread_hot_keys)
    hot_source = hot_keys(source, on, spread_hot_keys)

    def apply(t: DataFrame, s: DataFrame) -> DataFrame:
        ta = t.withColumn("_t_present", F.lit(True)).withColumn("_nk", target_salt(t, on, hot_target)).alias("t")
        sa = salted_source(t, s, on, hot_target, hot_source).withColumn("_s_present", F.lit(True)).alias("s")
        cond = F.col("t._nk") == F.col("s._nk")
        for k in on:
            cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
        j = ta.join(sa, cond, "full_outer")
        tp = F.col("t._t_present").isNotNull()
        sp = F.col("s._s_present").isNotNull()
        # A repeat of a source row that met no target row; another of them did.
        j = j.filter(tp | ~F.coalesce(F.col("s._in_target"), F.lit(False)))

        # Action code per row, first matching clause wins.
        act = None

        def add(when_cond, code):
            nonlocal act
            act = F.when(when_cond, F.lit(code)) if act is None else act.when(when_cond, F.lit(code))

        for i, c in enumerate(matched):
            cnd = tp & sp
            if c.condition is not None:
                cnd = cnd & F.coalesce(_expr(c.condition), F.lit(False))
            add(cnd, "D" if c.delete else f"U{i}")
        add(tp & sp, "K")
        for i, c in enumerate(inserts):
            cnd = sp & ~tp
            if c.condition is not None:
                cnd = cnd & F.coalesce(_expr(c.condition), F.lit(False))
            add(cnd, f"I{i}")
        add(sp & ~tp, "X")
        for i, c in enumerate(by_source):
            cnd = tp & ~sp
            if c.condition is not None:
                cnd = cnd & F.coalesce(_expr(c.condition), F.lit(False))
            add(cnd, "D" if c.delete else f"B{i}")
        act = act.otherwise(F.lit("K"))
        j = j.withColumn("_act", act).filter(~F.col("_act").isin("D", "X"))

        def keep(col):
            return F.col(f"t.{col}") if col in t.columns else F.lit(None)

        def from_source(col):
            return F.col(f"s.{col}") if col in src_cols else F.lit(None)

        outs = []
        for col in out_cols:
            v = None

            def branch(code, value):
                nonlocal v
                cnd = F.col("_act") == code
                v = F.when(cnd, value) if v is None else v.when(cnd, value)

            for i, c in enumerate(matched):
                if c.delete:
                    continue
                if c.update == STAR:
                    branch(f"U{i}", from_source(col) if (col in src_cols or col not in t.columns) else keep(col))
                elif col in c.update:
                    branch(f"U{i}", _expr(c.update[col]))
            for i, c in enumerate(inserts):
                if c.insert == STAR:
                    branch(f"I{i}", from_source(col))
                else:
                    branch(f"I{i}", _expr(c.insert[col]) if col in c.insert else F.lit(None))
            for i, c in enumerate(by_source):
                if not c.delete and col in (c.update or {}):
                    branch(f"B{i}", _expr(c.update[col]))
            v = keep(col) if v is None else v.otherwise(keep(col))
            outs.append(v.cast(types[col]).alias(col))
        return j.select(*outs)

    def passthrough(t: DataFrame) -> DataFrame:
        """Target rows no clause can touch, in the output schema."""
        t = add_missing_columns(t, source) if evolve else t
        return t.select(*[F.col(c).cast(types[c]).alias(c) for c in out_cols])

    if not matched and not by_source:
        # Insert-only: the target passes through untouched; only source rows
        # without a partner are inserted (anti join: broadcastable, skew-split by AQE).
        tk = target.select(*on)
        if hot_target:
            tk = tk.distinct()  # partial aggregation leaves a row a task of a hot key
        tk = tk.withColumn("_nk", F.lit(0).cast("long"))
        s_nk = source.withColumn("_nk", null_salt(source, on, -1))
        fresh = s_nk.join(tk, on + ["_nk"], "left_anti").drop("_nk")
        return passthrough(target).unionByName(apply(target.limit(0), fresh))

    return apply(target, source)


NULL_KEY_BUCKETS = 1024


def null_salt(df: DataFrame, on: Sequence[str], sign: int) -> Column:
    """Join-key salt: 0 for rows with a key, a hash bucket (signed per side,
    so the two sides never meet) for rows with a NULL key part. NULL keys
    never match; the salt only stops them from hashing into one task."""
    has_null = None
    for k in on:
        c = F.col(k).isNull()
        has_null = c if has_null is None else has_null | c
    if has_null is None:
        return F.lit(0).cast("long")
    return F.when(has_null, _dealt(df) * sign).otherwise(F.lit(0)).cast("long")


def _dealt(df: DataFrame) -> Column:
    """A bucket, from 1 on, for a row that meets no other."""
    return F.pmod(row_hash(df), F.lit(NULL_KEY_BUCKETS)) + 1


#: A side of at most so many bytes has no key that one task could not hold.
ONE_TASK_BYTES = 256 << 20


def hot_keys(df: DataFrame, on: Sequence[str], spread: bool | str) -> dict[int, int]:
    """Hash and row estimate of the hot keys of one side of a merge (see :func:`merge`)."""
    if spread == "auto":
        spread = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > ONE_TASK_BYTES
    return frequent_hashes(df, on) if spread else {}


def target_salt(t: DataFrame, on: Sequence[str], hot: Mapping[int, int]) -> Column:
    """The salt of a target row: rows of a hot key are dealt over the key's salts."""
    salt = null_salt(t, on, 1)
    return F.when(salt == 0, F.pmod(row_hash(t), salts(on, hot))).otherwise(salt).cast("long") if hot else salt


def salted_source(t: DataFrame, s: DataFrame, on: Sequence[str], hot_target: Mapping[int, int],
                  hot_source: Mapping[int, int]) -> DataFrame:
    """``s`` with its salt and ``_in_target``: true for a row of a hot key that ``t`` has, repeated for each salt of the key."""
    salt, hot = null_salt(s, on, -1), {**hot_source, **hot_target}
    if not hot:
        return s.withColumn("_nk", salt).withColumn("_in_target", F.lit(False))
    # The keys behind at most 2 * SHARE hashes.
    present = t.select(*on).filter(is_hot(on, hot)).distinct().withColumn("_in_target", F.lit(True))
    s = s.withColumn("_nk", salt).join(F.broadcast(present), list(on), "left")
    s = s.withColumn("_in_target", F.coalesce(F.col("_in_target"), F.lit(False)))
    alone = is_hot(on, hot) & ~F.col("_in_target") & (F.col("_nk") == 0)
    own = F.when(alone, F.array((_dealt(s) * -1).cast("long"))).otherwise(F.array(F.col("_nk").cast("long")))
    each = F.sequence(F.lit(0).cast("long"), salts(on, hot_target).cast("long") - 1)
    return s.withColumn("_nk", F.explode(F.when(F.col("_in_target"), each).otherwise(own)))


BUCKET_COL = "_bucket"


def bucket_of(on: Sequence[str], num_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in on]), F.lit(num_buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, on: Sequence[str], num_buckets: int) -> str:
    """Write a table partitioned by a hash bucket of its merge key."""
    (df.withColumn(BUCKET_COL, bucket_of(on, num_buckets)).hint("rebalance", BUCKET_COL)
     .write.mode("overwrite").partitionBy(BUCKET_COL).parquet(path))
    return path


def merge_into_buckets(spark, path: str, source: DataFrame, on: Sequence[str], clauses: Sequence,
                       num_buckets: int, staging: str, **kw) -> list[int]:
    """MERGE into a bucket-partitioned parquet table, rewriting only the
    buckets the source touches (copy-on-write per partition).

    The touched bucket list is bounded by ``num_buckets``; the target is read
    with partition pruning on those buckets, merged, staged, and the staged
    buckets replace theirs with dynamic partition overwrite. A bucket that the
    merge leaves without rows is removed. Clauses that act
    on target rows without a source partner (NOT MATCHED BY SOURCE) only see
    the touched buckets. Returns the touched buckets.
    """
    src = source.withColumn(BUCKET_COL, bucket_of(on, num_buckets))
    touched = sorted(r[0] for r in src.select(BUCKET_COL).distinct().collect())
    if not touched:
        return []
    target = spark.read.parquet(path).filter(F.col(BUCKET_COL).isin(touched))
    merged = merge(target, src, on, clauses, **kw)
    merged.hint("rebalance", BUCKET_COL).write.mode("overwrite").partitionBy(BUCKET_COL).parquet(staging)
    done = spark.read.schema(merged.schema).parquet(staging)
    left = {r[0] for r in done.select(BUCKET_COL).distinct().collect()}
    # Staged rows lie in files of their bucket already: they are copied as they lie, without a shuffle.
    (done.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL).parquet(path))
    remove_folders(spark, [f"{path.rstrip('/')}/{BUCKET_COL}={b}" for b in touched if b not in left])
    return touched
